"""Language identification by nearest centroid.

A text's letters, lower-cased, with one space for everything between them, give runs of 1, 2 and 3
characters; hashed, they are counted, damped by the logarithm, weighted by inverse document frequency and
brought to length 1. Each language has several centroids, found by spherical k-means on a sample of
its labelled rows. The nearest by cosine names the language. A text is rejected if it is farther from its
centroid than nearly all labelled texts of that language and its size are from centroids that were
fitted without them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from skyledger.llm.common import hash60, in_small_batches, key_text, saved

# About so many rows per language, chosen by a hash of their id, bound the work of the fit.
SAMPLE_PER_LANGUAGE = 2000
CENTROIDS = 4
ROUNDS = 12
DIMENSIONS = 1 << 12
RUNS = (1, 2, 3)
# The bound of rejection is taken for texts with about so many different runs, which tells better than their
# length how much they say: a word repeated a thousand times is a short text. Between two, it is interpolated.
SIZES = tuple(2 ** (k / 2) for k in range(4, 25))
# Texts are cut to so many letters and spaces, so that all sizes are known from all texts.
LENGTHS = tuple(3 << k for k in range(14))
# Cosines of so many parts of the sample come from centroids fitted on the other parts.
FOLDS = 4
# The bound lies farther below the median of these cosines than so low a quantile, by the power SLACK of its
# share of the median; and at least by the power SPREAD of the share that the lowest sixth of them ends with,
# as few rows know no such quantile.
QUANTILE = 0.01
SLACK = 2.0
SPREAD = 8.0
# A bound for a size needs so many cosines; else the next smaller size's holds.
LEAST_TEXTS = 10
ROWS_AT_ONCE = 256
UNKNOWN = "und"

_codes: list[np.ndarray] = []
_SPACE = np.array([32], dtype=np.uint64)


def _letter_codes() -> np.ndarray:
    """Per code point: its lower-case form if it is a letter, else a space. Built once per process."""
    if not _codes:
        table = np.full(0x110000, 32, dtype=np.uint64)
        for code in range(0x110000):
            if (letter := chr(code)).isalpha():
                low = letter.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _codes.append(table)
    return _codes[0]


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters with one space between runs of them and at both ends; empty without letters."""
    if not text:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.concatenate((_SPACE, _letter_codes()[raw], _SPACE))
    gap = code == 32
    if gap.all():
        return np.empty(0, np.uint64)
    again = np.concatenate(([False], gap[1:] & gap[:-1]))
    return code[~again]


def counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of all character runs; None if the text has no letter."""
    code = letters(text)
    return run_counts(code) if len(code) else None


def run_counts(code: np.ndarray) -> np.ndarray:
    """Hashed counts of all runs of what :func:`letters` gives."""
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for n in RUNS:
        if len(code) >= n:
            value = np.full(len(code) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                value = value * np.uint64(0x9E3779B97F4A7C15) + code[k : len(code) - n + 1 + k]
            value ^= value >> np.uint64(31)
            value *= np.uint64(0xBF58476D1CE4E5B9)
            value ^= value >> np.uint64(29)
            total += np.bincount((value >> np.uint64(52)).astype(np.int64), minlength=DIMENSIONS)
    return total


def stacked(found: Iterable[np.ndarray], n: int) -> np.ndarray:
    """``n`` rows of counts as one matrix, filled row by row."""
    rows = np.empty((n, DIMENSIONS), dtype=np.float32)
    for row, c in zip(rows, found):
        row[:] = c
    return rows


def vectors(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Counts, a float matrix that is overwritten, as TF-IDF vectors of length 1."""
    np.log1p(rows, out=rows)
    rows *= idf
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    rows /= np.where(lengths > 0, lengths, 1)
    return rows


@dataclass(frozen=True)
class Model:
    """``least`` has a row per centroid: the bound of rejection for each of SIZES, or one for all sizes."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
        """Per text: language, cosine, whether it is rejected."""
        for at in range(0, len(texts), ROWS_AT_ONCE):
            found = [counts(t) for t in texts[at : at + ROWS_AT_ONCE]]
            some = [c for c in found if c is not None]
            if some and self.languages:
                near = vectors(stacked(some, len(some)), self.idf) @ self.centroids.T
                best = near.argmax(axis=1)
                bounds = self.least.reshape(len(self.languages), -1)[best]
                answers = iter(zip(best, near[np.arange(len(best)), best], map(bound, bounds, some)))
            for c in found:
                if c is None or not self.languages:
                    yield UNKNOWN, 0.0, True
                else:
                    k, cosine, least = next(answers)
                    score = float(min(max(cosine, 0.0), 1.0))
                    yield self.languages[k], score, score < least


def cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means. Each start is the row farthest from the starts before it."""
    centers = [rows[0]]
    while len(centers) < min(k, len(rows)):
        centers.append(rows[(rows @ np.stack(centers).T).max(axis=1).argmin()])
    found = np.stack(centers)
    for _ in range(ROUNDS):
        nearest = (rows @ found.T).argmax(axis=1)
        sums = np.stack([rows[nearest == j].sum(axis=0) if (nearest == j).any() else found[j] for j in range(len(found))])
        found = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return found


def bound(least: np.ndarray, c: np.ndarray) -> float:
    """The bound of rejection for a text with counts ``c``."""
    return float(np.interp(np.log2(np.count_nonzero(c)), np.log2(SIZES[: len(least)]), least))


def radius(texts: list[np.ndarray], rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Per size the bound of rejection, from ``texts``, whole and cut, whose vectors when whole are ``rows``.

    A text's cosine is that to the nearest of the centroids that were fitted without its fold. With too few
    texts for that nothing is rejected.
    """
    least, fold = np.zeros(len(SIZES)), np.arange(len(texts)) % FOLDS
    if len(texts) < FOLDS:
        return least
    sizes, near = [], []
    for f in range(FOLDS):
        centers = cluster(rows[fold != f], CENTROIDS)
        own = [t for t, of in zip(texts, fold) if of == f]
        cut = own + [np.append(t[: length - 1], _SPACE) for length in LENGTHS for t in own if len(t) > length]
        for at in range(0, len(cut), ROWS_AT_ONCE):
            part = stacked(map(run_counts, cut[at : at + ROWS_AT_ONCE]), len(cut[at : at + ROWS_AT_ONCE]))
            sizes.append(np.count_nonzero(part, axis=1))
            near.append((vectors(part, idf) @ centers.T).max(axis=1))
    place, cosines = np.rint(2 * np.log2(np.concatenate(sizes) / SIZES[0])), np.concatenate(near)
    for k in range(len(SIZES)):
        some = cosines[place == k]
        if len(some) < LEAST_TEXTS:
            least[k] = least[max(k - 1, 0)]
            continue
        low, sixth, middle = np.maximum(np.quantile(some, [QUANTILE, 1 / 6, 0.5]), 1e-9)
        least[k] = middle * min((low / middle) ** SLACK, (sixth / middle) ** SPREAD)
    return least


def held_out(id_column: str) -> Column:
    """Whether the row is kept from learning: crc32 of the id as text, mod 3, is 1. A NULL id counts as empty text."""
    return F.crc32(key_text(id_column).cast("binary")) % 3 == 1


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """Learn from rows with a language that are not held out.

    What comes to the driver is one row per centroid, 16 KiB each; there are four per language.
    """
    usable = docs.select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"), hash60(key_text(id_column)).alias("key"), held_out(id_column).alias("held_out")
    ).filter("lang IS NOT NULL AND text IS NOT NULL AND NOT held_out")
    # Written, so that Spark knows how few rows it has and does not shuffle the texts to join it.
    rates = saved(usable.groupBy("lang").agg((F.lit(float(SAMPLE_PER_LANGUAGE)) / F.count("*")).alias("rate")))
    sample = saved(
        usable.join(rates, "lang").filter(F.col("key") < F.col("rate") * float(1 << 60)).select("lang", "key", "text").repartition(16, "key")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIMENSIONS)
        for batch in batches:
            for c in map(counts, batch.column(0).to_pylist()):
                if c is not None:
                    n, df = n + 1, df + (c > 0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df], pa.list_(pa.float64()))], ["n", "df"])

    parts = in_small_batches(sample.select("text")).mapInArrow(frequencies, "n long, df array<double>").collect()
    n = sum(r.n for r in parts)
    idf = (np.log((1 + n) / (1 + sum((np.array(r.df) for r in parts), np.zeros(DIMENSIONS)))) + 1).astype(np.float32)

    def centroids(group: pa.Table) -> pa.Table:
        texts = group.sort_by([("key", "ascending"), ("text", "ascending")]).column("text").to_pylist()
        codes = [code for code in map(letters, texts) if len(code)]
        centers, least = np.empty((0, DIMENSIONS), np.float32), np.zeros(len(SIZES))
        if codes:
            rows = vectors(stacked(map(run_counts, codes), len(codes)), idf)
            centers = cluster(rows, CENTROIDS)
            least = radius(codes, rows, idf)
        return pa.table({
            "lang": pa.array([group.column("lang")[0].as_py()] * len(centers), pa.string()),
            "centroid": pa.array(list(centers), pa.list_(pa.float32())),
            "least": pa.array([least] * len(centers), pa.list_(pa.float64())),
        })

    found = sample.groupBy("lang").applyInArrow(centroids, "lang string, centroid array<float>, least array<double>").collect()
    found.sort(key=lambda r: r.lang)
    rows = np.array([r.centroid for r in found], dtype=np.float32).reshape(len(found), DIMENSIONS)
    return Model(idf, rows, [r.lang for r in found], np.array([r.least for r in found]).reshape(len(found), len(SIZES)))


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The input columns, and _lang, _score, _rejected of each row.

    A NULL text, and one without a letter, is ``und`` with score 0 and rejected; so is every text if
    nothing could be learned. Other rejected texts keep the nearest language's name. Ties go to the
    language first by code point. Input columns named like the added ones are replaced.
    """
    rows = docs.drop("_lang", "_score", "_rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.predict(batch.column(text_column).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([bool(f[2]) for f in found], pa.bool_())],
                [*batch.schema.names, "_lang", "_score", "_rejected"],
            )

    schema = StructType(list(rows.schema.fields)).add("_lang", StringType()).add("_score", DoubleType()).add("_rejected", BooleanType())
    return in_small_batches(rows).mapInArrow(run, schema)
