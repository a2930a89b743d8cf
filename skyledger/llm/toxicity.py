"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other by logistic regressions on hashed words and word beginnings;
each takes the probabilities of the categories before it as features. To learn from such features as
they will be, not as a fitted model flatters its own rows, each category is first fitted without one fold
at a time and predicts that fold; these out-of-fold probabilities are what the next model learns from,
and what the decision threshold of the category is chosen on. Folds are fitted in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from skyledger.llm.common import hash60, in_small_batches, key_text, saved
from skyledger.llm.shingles import prefix_hashes

# About so many labelled rows, chosen by a hash of their id, bound the work of the fit.
SAMPLE = 6000
FOLDS = 4
FEATURE_BITS = 16
# Besides whole words, their first bytes: endings vary, and other languages glue words together.
BEGINNINGS = (5, 7)
LENGTH = 5.0
STEPS = 150
PENALTY = 1e-5
SLICE = 512


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and how often each occurs; none for NULL and wordless texts."""
    hashes = prefix_hashes(text, BEGINNINGS)
    return np.unique((hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), return_counts=True)


def weigh(features: np.ndarray, found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with damped counts, of fixed length, so that a text's size does not count."""
    values = np.log1p(found) * idf[features]
    length = np.linalg.norm(values)
    return values / length * LENGTH if length else values


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


@dataclass(frozen=True)
class Rows:
    """Sparse rows: row i has features[bounds[i]:bounds[i + 1]]; ``earlier`` are the chain's probabilities."""

    features: np.ndarray
    values: np.ndarray
    bounds: np.ndarray
    earlier: np.ndarray

    def margins(self, weights: np.ndarray) -> np.ndarray:
        n, m = self.earlier.shape
        row = np.repeat(np.arange(n), np.diff(self.bounds))
        sums = np.bincount(row, self.values * weights[self.features], n)
        return sums + self.earlier @ weights[-1 - m : -1] + weights[-1]

    def gradient(self, errors: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(errors)), np.diff(self.bounds))
        words = np.bincount(self.features, self.values * errors[row], 1 << FEATURE_BITS)
        return np.concatenate((words, self.earlier.T @ errors, [errors.sum()])) / len(errors)


def fit(rows: Rows, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by accelerated gradient steps: feature weights, earlier categories' weights, intercept."""
    size = (1 << FEATURE_BITS) + rows.earlier.shape[1] + 1
    weights, ahead, momentum = np.zeros(size), np.zeros(size), 1.0
    step = 1 / (0.25 * (LENGTH**2 + rows.earlier.shape[1] + 1) + PENALTY)
    for _ in range(STEPS):
        slope = rows.gradient(_logistic(rows.margins(ahead)) - labels)
        slope[:-1] += PENALTY * ahead[:-1]
        moved = ahead - step * slope
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / following * (moved - weights)
        weights, momentum = moved, following
    return weights


def best_threshold(probabilities: np.ndarray, labels: np.ndarray) -> float:
    """The probability from which calling a row positive gives the best F1; above 1 without positives."""
    if not labels.any():
        return 2.0
    order = np.argsort(-probabilities, kind="stable")
    hits = np.cumsum(labels[order])
    scores = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    # Of equal probabilities all are called, so only the last of them can be a cut.
    last = np.append(np.diff(probabilities[order]) != 0, True)
    at = int(np.argmax(np.where(last, scores, -1)))
    below = probabilities[order][at + 1] if at + 1 < len(order) else 0.0
    return float((probabilities[order][at] + below) / 2)


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    idf: np.ndarray
    weights: list[np.ndarray]
    thresholds: list[float]

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Rows of one probability per category; 0 for texts without words, and for all if nothing was learned."""
        answers = np.zeros((len(texts), len(self.categories)))
        found = [counts(t) for t in texts]
        some = [i for i, (features, _) in enumerate(found) if len(features)]
        if not some or not self.weights:
            return answers
        features = np.concatenate([found[i][0] for i in some])
        values = np.concatenate([weigh(*found[i], self.idf) for i in some])
        bounds = np.cumsum([0, *[len(found[i][0]) for i in some]])
        earlier = np.zeros((len(some), 0))
        for weights in self.weights:
            p = _logistic(Rows(features, values, bounds, earlier).margins(weights))
            earlier = np.column_stack((earlier, p))
        answers[some] = earlier
        return answers


def _rows_of(group: pd.DataFrame, earlier: int) -> Rows:
    lengths = [len(f) for f in group["features"]]
    return Rows(
        np.concatenate(list(group["features"])) if len(group) else np.empty(0, np.int64),
        np.concatenate(list(group["weights"])).astype(np.float64) if len(group) else np.empty(0),
        np.cumsum([0, *lengths]),
        np.array([p[:earlier] for p in group["earlier"]], dtype=np.float64).reshape(len(group), earlier),
    )


def _fold_fits(rows: DataFrame, number: int) -> DataFrame:
    """key, p (out-of-fold), and one row with weights: of category ``number``, on rows of all folds."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "id"])
        part = int(group["part"].iloc[0])
        train = group[group["fold"] != part]
        labels = np.array([y[number] for y in train["labels"]], dtype=np.float64)
        weights = fit(_rows_of(train, number), labels)
        if part == FOLDS:
            return pd.DataFrame({"id": [None], "p": [None], "weights": [weights.tolist()]})
        rest = group[group["fold"] == part]
        return pd.DataFrame({"id": rest["id"].to_numpy(), "p": _logistic(_rows_of(rest, number).margins(weights)), "weights": None})

    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
    return parts.groupBy("part").applyInPandas(run, "id long, p double, weights array<double>")


def learn(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_column: str = "doc_id", text_column: str = "text") -> Chain:
    """Fit the chain on labelled rows. Labels are 0 or 1; rows with a NULL id or label are left out.

    Of repeated label rows of one id the largest labels count. Every fit holds the sample in one task, which
    :data:`SAMPLE` bounds; the driver gets one weight vector per category and the sample's probabilities.
    """
    known = labels.select(F.col(id_column).alias("id"), *[F.col(c).cast("double").alias(c) for c in categories])
    known = known.dropna().groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
    rate = SAMPLE / max(1, known.count())
    chosen = saved(known.withColumn("key", hash60(key_text("id"))).filter(F.col("key") < rate * float(1 << 60)))
    sample = saved(
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")).filter("text IS NOT NULL")
        .join(chosen, F.col("_id") == F.col("id")).repartition(16, "key")
    )

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [counts(t) for t in batch["text"]]
            yield pd.DataFrame({
                "key": batch["key"], "features": [f for f, _ in found], "found": [n for _, n in found],
                "labels": batch[list(categories)].to_numpy().tolist(),
            })

    made = "key long, features array<long>, found array<long>, labels array<double>"
    rows = saved(
        in_small_batches(sample.select("key", "text", *categories)).mapInPandas(featurise, made).filter(F.size("features") > 0)
        .withColumn("id", F.monotonically_increasing_id()).withColumn("fold", (F.col("key") % FOLDS).cast("int"))
    )

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(1 << FEATURE_BITS)
        for batch in batches:
            for f in batch["features"]:
                n, df[f] = n + 1, df[f] + 1
        yield pd.DataFrame({"n": [n], "df": [df]})

    parts = rows.select("features").mapInPandas(frequencies, "n long, df array<double>").collect()
    n = sum(r.n for r in parts)
    if not n:
        return Chain(list(categories), np.ones(1 << FEATURE_BITS), [], [2.0] * len(categories))
    idf = np.log((1 + n) / (1 + sum(np.array(r.df) for r in parts))) + 1

    def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["weights"] = [weigh(f, c, idf) for f, c in zip(batch["features"], batch["found"])]
            yield batch.drop(columns="found")

    state = saved(
        rows.mapInPandas(weighed, "key long, features array<long>, labels array<double>, id long, fold int, weights array<float>")
        .withColumn("earlier", F.array().cast("array<double>"))
    )
    weights, thresholds = [], []
    for number in range(len(categories)):
        fits = saved(_fold_fits(state, number))
        weights.append(np.array(fits.filter("weights IS NOT NULL").first().weights))
        out = fits.filter("p IS NOT NULL").select("id", "p")
        judged = out.join(state.select("id", F.get("labels", F.lit(number)).alias("y")), "id").select("p", "y").collect()
        thresholds.append(best_threshold(np.array([r.p for r in judged]), np.array([r.y for r in judged])))
        state = saved(state.join(out, "id").withColumn("earlier", F.array_append("earlier", F.col("p"))).drop("p"))
    return Chain(list(categories), idf, weights, thresholds)


def score(docs: DataFrame, chain: Chain, text_column: str = "text") -> DataFrame:
    """The input columns, and for each category _p_<name> (probability) and _is_<name> (from its threshold on).

    NULL, empty and wordless texts have probability 0 and are in no category; so has every text if no labelled
    row was there to learn from. Input columns named like the added ones are replaced.
    """
    added = [f"_{kind}_{c}" for c in chain.categories for kind in ("p", "is")]
    rows = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                p = shared.value.predict(batch.column(text_column).to_pylist())
                columns = []
                for k, threshold in enumerate(shared.value.thresholds):
                    columns += [pa.array(p[:, k], pa.float64()), pa.array((p[:, k] >= threshold) & (p[:, k] > 0), pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    schema = StructType(list(rows.schema.fields))
    for name in added:
        schema = schema.add(name, DoubleType() if name.startswith("_p_") else BooleanType())
    return in_small_batches(rows).mapInArrow(run, schema)
