"""Benchmark passages in documents, found with one Aho-Corasick automaton.

Benchmark items and documents are brought to one form: A-Z lower-cased, words of letters, digits and
non-ASCII characters, one space between. The automaton holds every window of 10 item words; a document
is scanned once, and what it finds is mapped back to word numbers and to places in the original text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import carried, in_small_batches, saved

WINDOW = 10
# The columns that :func:`find_contamination` adds.
ADDED = ["_n_words", "_n_hit", "_spans", "_items", "_contaminated"]
# Windows of about so many bytes of benchmark text go into one automaton, and no worker holds two. A benchmark within
# that is broadcast. A larger one stays in Spark, in parts by item, and meets the documents in blocks.
AUTOMATON_BYTES = 8 << 20
# Documents of about so many bytes are a block: reading them takes much longer than building a part's automaton.
BLOCK_BYTES = 256 << 20

# Fixed by the query contract: everything else in ASCII separates words.
_FORM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased; none for NULL."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FORM).split()


def windows(text: str | None, width: int = WINDOW) -> list[str]:
    """Each run of ``width`` words, or the whole of a shorter text; with a space at both ends."""
    words = normal_words(text)
    last = max(1, len(words) - width + 1) if words else 0
    return [f" {b' '.join(words[i : i + width]).decode('utf-8', 'surrogatepass')} " for i in range(last)]


def build_automaton(items: list[tuple[str | None, str]]) -> ahocorasick.Automaton:
    """From (item id as text, item text): each window leads to (words, length, ids of its items, of which NULL is none)."""
    found: dict[str, set[str]] = {}
    for item, text in items:
        for window in windows(text):
            found.setdefault(window, set()).update(() if item is None else (item,))
    automaton = ahocorasick.Automaton()
    for window, ids in found.items():
        automaton.add_word(window, (window.count(" ") - 1, len(window), tuple(sorted(ids))))
    if found:
        automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words; hit runs of word numbers (start, end exclusive), merged and in order; item ids."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), [], set()
    form = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    starts: list[int] = []
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    for end, (n, length, ids) in automaton.iter(form):
        if not starts:
            place = 0
            for word in form.split(" ")[1:-1]:
                starts.append(place)
                place += len(word) + 1
        first = bisect_left(starts, end + 1 - length)
        items.update(ids)
        runs.append((first, first + n))
    runs.sort()
    merged: list[tuple[int, int]] = []
    for first, last in runs:
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return len(words), merged, items


def placed_runs(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of word numbers, with their first and last code points in the text as it was, both ends exclusive."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": a, "end": b, "first": places[a][0], "last": places[b - 1][1]} for a, b in runs]


# One automaton per broadcast and Python worker, as building it takes longer than a batch of documents.
_built: dict[str, ahocorasick.Automaton] = {}

_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "end", "first", "last")]))
_SQL_RUNS = "array<struct<start: bigint, end: bigint, first: bigint, last: bigint>>"
_NAMES = ["_n_words", "_runs", "_items"]
_FOUND = f"_n_words bigint, _runs {_SQL_RUNS}, _items array<string>"


def _automaton(name: str, items: list[tuple[str | None, str]]) -> ahocorasick.Automaton:
    if name not in _built:
        _built.clear()
        _built[name] = build_automaton(items)
    return _built[name]


def _answers(automaton: ahocorasick.Automaton, texts: list[str | None]) -> list[pa.Array]:
    """The columns of ``_FOUND``."""
    found = [scan(automaton, text) for text in texts]
    return [
        pa.array([n for n, _, _ in found], pa.int64()),
        pa.array([placed_runs(text, runs) for text, (_, runs, _) in zip(texts, found)], _RUNS),
        pa.array([sorted(ids) for _, _, ids in found], pa.list_(pa.string())),
    ]


def _scan_at_once(rows: DataFrame, items: DataFrame) -> DataFrame:
    """_keep and ``_FOUND`` of every row, for items that fit into one automaton, which all tasks get."""
    listed = [(r.item, r.text) for r in items.collect()]
    shared = rows.sparkSession.sparkContext.broadcast(listed)
    name = str(id(shared)) + str(hash(tuple(listed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, shared.value)
        for batch in batches:
            answers = _answers(automaton, batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("_keep"), *answers], ["_keep", *_NAMES])

    kept = rows.schema["_keep"].dataType.simpleString()
    return in_small_batches(rows).mapInArrow(run, f"_keep {kept}, {_FOUND}")


def _scan_in_blocks(rows: DataFrame, items: DataFrame, parts: int) -> DataFrame:
    """The same for items of any size.

    Every block of documents meets every part of the items, as one sorted stream: the part, of which the automaton is
    built, then the documents. So a task holds one part and one batch, and the driver nothing. Only rows that hold
    something leave their block, without their text.
    """
    numbered = saved(rows.withColumn("_row", F.monotonically_increasing_id()))
    size = numbered.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    null = F.lit(None).cast("string")
    of_items = items.select(
        F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("row"), "item", "text",
    )
    of_docs = numbered.filter("_text IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.pmod(F.xxhash64("_row"), F.lit(blocks)).alias("block"), F.lit(1).alias("kind"),
        F.col("_row").alias("row"), null.alias("item"), F.col("_text").alias("text"),
    )
    stream = of_items.unionByName(of_docs).repartition("part", "block").sortWithinPartitions("part", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, listed, automaton = None, [], None
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("part", "block", "kind")]))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                run_of_key = batch.slice(at, end - at)
                if place != keys[at][:2]:
                    place, listed, automaton = keys[at][:2], [], None
                texts = run_of_key.column("text").to_pylist()
                if keys[at][2] == 0:
                    listed += zip(run_of_key.column("item").to_pylist(), texts)
                else:
                    if automaton is None:
                        automaton, listed = build_automaton(listed), []
                    answers = _answers(automaton, texts)
                    # The first part tells the number of words of every text.
                    some = [k for k, n in enumerate(answers[1].value_lengths().to_pylist()) if n or place[0] == 0]
                    found = pa.RecordBatch.from_arrays([run_of_key.column("row"), *answers], ["row", *_NAMES])
                    yield found.take(pa.array(some, pa.int64()))
                at = end

    found = in_small_batches(stream).mapInArrow(run, f"row bigint, {_FOUND}")
    merged = found.groupBy("row").agg(
        F.max("_n_words").alias("_n_words"),
        _union(F.flatten(F.collect_list("_runs"))).alias("_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
    )
    return numbered.join(merged, F.col("_row") == F.col("row"), "left").select(
        "_keep", F.coalesce("_n_words", F.lit(0).cast("long")).alias("_n_words"),
        F.coalesce("_runs", F.array().cast(_SQL_RUNS)).alias("_runs"), F.coalesce("_items", F.array().cast("array<string>")).alias("_items"),
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], id_column: str = "item_id",
                       text_column: str = "text") -> DataFrame:
    """``keep`` columns of every row, and what of the benchmark its text holds.

    _n_words, _n_hit (words in any occurrence of a window), _spans (their places in the text, code points, end
    exclusive), _items (ids as text, distinct, in order), _contaminated. NULL and empty texts have no
    words and are clean; NULL or wordless items have no windows; an item without id marks words, but is not
    named, while the empty text is an id like any other; repeated items and rows change nothing; other columns are not
    read. No rows give no rows. ``keep`` may have any names; one like an added column's is replaced by that.
    """
    rows = docs.select(carried(keep, ADDED), F.col(text_column).cast("string").alias("_text"))
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text")).filter(
        "text IS NOT NULL"
    ).distinct()
    # Every word stands in up to WINDOW windows.
    total = items.agg(F.sum(F.octet_length("text") * WINDOW)).first()[0] or 0
    if total <= AUTOMATON_BYTES:
        found = _scan_at_once(rows, items)
    else:
        # Parts are uneven, so they are half as large on average.
        found = _scan_in_blocks(rows, saved(items), 2 * -(-total // AUTOMATON_BYTES))
    hit = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    spans = F.transform("_runs", lambda r: F.struct(r["first"].alias("start"), r["last"].alias("end")))
    return found.withColumns({"_n_hit": hit, "_spans": spans}).select(
        "_keep.*", "_n_words", "_n_hit", "_spans", "_items", (F.col("_n_hit") > 0).alias("_contaminated")
    )


def _union(runs: Column) -> Column:
    """Sorted; runs that overlap or touch, as words, are merged."""

    def add(done, r):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"),
            last["first"].alias("first"), F.greatest(last["last"], r["last"]).alias("last"),
        )
        before = F.slice(done, F.lit(1), F.size(done) - 1)
        return F.when((F.size(done) > 0) & (r["start"] <= last["end"]), F.concat(before, F.array(joined))).otherwise(
            F.concat(done, F.array(r))
        )

    return F.aggregate(F.array_sort(runs), F.array().cast(_SQL_RUNS), add)
