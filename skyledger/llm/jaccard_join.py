"""Documents linked by the Jaccard similarity of their word shingles, by prefix filtering.

Shingles are ordered rare first. Two sets of similarity 0.75 or more share a shingle among the rarest
quarter of each, the prefix; so only sets that meet there are compared, after filters on their lengths,
on the positions at which they meet, and on how the rest is spread. A pair is verified once.

The classes need no list of all links. Among the sets that share a prefix shingle, all are first compared
with a few pivots, which joins most of a group of near copies in one round and without its square of pairs;
some rounds repeat with other pivots, and a last one compares what is left in different classes pair by pair. Pairs within one class are never made, and none between classes is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from skyledger.llm.common import flagged, flags, in_small_batches, is_flagged, saved
from skyledger.llm.components import components
from skyledger.llm.shingles import fingerprint, shingle_sets

# A first count of shingles is kept by hash in a table of fixed size. Sharing an entry makes a shingle look
# less rare, never rarer. Shingles that look more common than chance makes an entry of the table are ordered by it
# alone, behind all others; so no shingle of the exact count below has more documents than the table says.
COUNT_BITS = 22
CHUNK = 1 << 16
# The least common shingles by the table, about this share of those that are not common, come first in the order. Most sets
# have their prefix among these alone, and send no others to the exact count.
LOW_SHARE = 0.4
# What the number of a shingle's documents is raised by, beyond any such number, where it is not among these.
HIGH = 1 << 30
# The exact count gathers shingles by leading hash bits, in parts of about so many bytes.
PART_BYTES = 12 << 20
PART_SLICE = 1024
# A set is described by how many of its shingles fall into each of so many ranges of hashes, counted up to a byte. Below a
# thousand shingles, sets that have little in common are told apart by that.
SPREAD_BITS = 6
MOST_SPREAD = 127
# Documents of a batch are taken in slices of so many, which bounds the memory of a Python worker.
SLICE = 256
# So many sets of each shingle are pivots of one round.
PIVOTS = 4
# Sets that share a shingle with few others are all compared at once, and done with.
FEW = 6
# Pivot rounds go on while pairs between classes outnumber the entries by this factor.
PAIRS_PER_ENTRY = 2
MAX_PIVOT_ROUNDS = 3


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _texts(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[tuple[pa.RecordBatch, Iterator[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, shingle_sets(part.column("_text").to_pylist())


def _lists(arrays: list[np.ndarray], kind: type) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(kind) if len(values) else values.astype(kind)))


def _entry(shingles: np.ndarray) -> np.ndarray:
    """Where in the count table each shingle is counted."""
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _describe(docs: DataFrame) -> DataFrame:
    """One row per document: id, n, hi, lo (its set's fingerprint), spread; and rows of shingle counts."""
    kind = docs.schema["_id"].dataType.simpleString()
    docs_type = to_arrow_type(docs.schema["_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
        for batch, sets in _texts(batches):
            n, hi, lo, spread, entries = [], [], [], [], []
            for s in sets:
                high, low = fingerprint(s)
                n.append(len(s)), hi.append(high), lo.append(low)
                ranges = np.bincount((s >> np.uint64(64 - SPREAD_BITS)).astype(np.int64), minlength=1 << SPREAD_BITS)
                spread.append(np.minimum(ranges, MOST_SPREAD).astype(np.int8))
                entries.append(_entry(s))
            at, k = np.unique(np.concatenate(entries), return_counts=True)
            counts[at] += k.astype(np.uint32)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 _lists(spread, np.int8), none.cast(pa.int32()), none.cast(pa.binary())],
                ["_id", "n", "hi", "lo", "spread", "chunk", "counts"],
            )
        if counts.any():
            types = [docs_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int8())]
            for chunk, part in enumerate(counts.reshape(-1, CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1).cast(t) for t in types], pa.array([chunk], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                    ["_id", "n", "hi", "lo", "spread", "chunk", "counts"],
                )

    return docs.mapInArrow(run, f"_id {kind}, n long, hi long, lo long, spread array<tinyint>, chunk int, counts binary")


def _rarity(described: DataFrame) -> np.ndarray:
    """For each entry of the count table: how common its shingles are, on a scale of logarithms."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(counts), dtype=np.uint32).astype(np.int64)
                sums[chunk] = sums.get(chunk, 0) + part
        ranks = [np.round(np.log2(1.0 + s) * 512).astype(np.uint16).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], ["chunk", "ranks"])

    chunks = (1 << COUNT_BITS) // CHUNK
    rows = (
        described.filter("chunk IS NOT NULL").select("chunk", "counts").repartition(chunks, "chunk")
        .mapInArrow(add, "chunk int, ranks binary").collect()
    )
    table = np.zeros((chunks, CHUNK), dtype=np.uint16)
    for row in rows:
        table[row.chunk] = np.frombuffer(row.ranks, dtype=np.uint16)
    return table.ravel()


def _common_from(total: int) -> int:
    """The rank in the table from which a shingle is common: four deviations above the mean of its entries, and some."""
    mean = total / (1 << COUNT_BITS)
    return int(np.round(np.log2(1.0 + mean + 4 * mean**0.5 + 8) * 512)) + 1


def _low_below(rarity: np.ndarray, common_from: int) -> int:
    """The rank in the table below which there is about LOW_SHARE of all shingles that are not common."""
    ranks = np.arange(1 << 16)
    below = np.cumsum((np.bincount(rarity, minlength=1 << 16) * (np.exp2(ranks / 512) - 1))[:common_from])
    return int(np.searchsorted(below, LOW_SHARE * below[-1])) + 1 if len(below) else 0


def _sent(rank: np.ndarray, low_below: int, common_from: int) -> np.ndarray:
    """Which shingles of a set, by their ranks in the table, go to the exact count: all low ones, and the others only
    if the prefix is longer than these. Common ones never do."""
    low = rank < low_below
    return low if np.count_nonzero(low) >= prefix_length(len(rank)) else rank < common_from


def _part_bits(total: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, total * 12 / PART_BYTES)))))


def _numbered(values: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of 64-bit values."""
    return (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)


def _cut(numbers: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The numbers that occur, ascending, and for each array its elements by number. Numbers that do not occur cost nothing."""
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.empty(0, np.int64)
    return numbers[starts], [np.split(array[order], starts[1:]) if len(starts) else [] for array in arrays]


# What a row of packed arrays holds: rare shingles with their numbers of documents; sizes of sets; places of common shingles.
RARE, SIZES, COMMON = range(3)


def _by_part(docs: DataFrame, rarity: np.ndarray, total: int) -> DataFrame:
    """For each bucket of sets (leading bits of lo) packed rows: kind, bucket, doc (lo), wide, number.

    Shingles that can be in a prefix and are not common meet by the leading bits of their hash, in parts, where they are counted.
    Those that several sets sent go on as wide, with their count as number, raised by HIGH unless they are low, to the
    bucket of each set: a part sends one row of arrays to each bucket that occurs in it. Sizes of sets (of common shingles
    as number, of low ones and of all as halves of wide) and the common shingles of prefixes (their position as number)
    pass through, dealt by the bucket of their set.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rarity)
    bits, common_from = _part_bits(total), _common_from(total)
    low_below = _low_below(rarity, common_from)
    parts = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value

        def rows(kind: int, numbers: np.ndarray, doc: np.ndarray, token: np.ndarray, number: np.ndarray | None = None) -> pa.RecordBatch:
            found, (docs, tokens, counts) = _cut(numbers, doc, token, np.zeros(len(doc), np.int32) if number is None else number)
            none = [np.empty(0, np.int32)] * len(found)
            wide = kind != RARE
            arrays = [
                pa.array((kind * parts + found).astype(np.int64)), _lists(docs, np.int64),
                _lists(none if wide else tokens, np.int32), _lists(tokens if wide else none, np.int64), _lists(counts if wide else none, np.int32),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["slot", "doc", "token", "wide", "number"])

        for _, sets in _texts(batches, PART_SLICE):
            rare, owners, names, sizes, n_common, wide, position, wide_owner = [], [], [], [], [], [], [], []
            for s in sets:
                if not len(s):
                    continue
                lo = fingerprint(s)[1]
                rank = ranks[_entry(s)]
                common = rank >= common_from
                some = s[_sent(rank, low_below, common_from)]
                rare.append(some), owners.append(np.full(len(some), lo, dtype=np.int64))
                names.append(lo), sizes.append(np.count_nonzero(rank < low_below) << 32 | len(s)), n_common.append(np.count_nonzero(common))
                more = prefix_length(len(s)) - len(some)
                if more > 0:
                    first = s[common][np.argsort(rank[common], kind="stable")[:more]]
                    wide.append(first), position.append(np.arange(len(some), len(some) + more)), wide_owner.append(np.full(more, lo))
            if not names:
                continue
            tokens, doc = np.concatenate(rare), np.concatenate(owners)
            token = ((tokens >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            yield rows(RARE, _numbered(tokens, bits), doc, token)
            names = np.array(names, np.int64)
            yield rows(SIZES, _numbered(names.view(np.uint64), bits), names, np.array(sizes, np.int64), np.array(n_common, np.int32))
            if wide:
                doc = np.concatenate(wide_owner).astype(np.int64)
                yield rows(COMMON, _numbered(doc.view(np.uint64), bits), doc, np.concatenate(wide).view(np.int64), np.concatenate(position).astype(np.int32))

    gathered = docs.mapInArrow(run, "slot long, doc array<long>, token array<int>, wide array<long>, number array<int>")

    def packed(kind: int, buckets: np.ndarray, docs: list, wide: list, numbers: list) -> pa.Table:
        return pa.table([
            pa.array(np.full(len(buckets), kind, np.int32)), pa.array(buckets.astype(np.int32)),
            _lists(docs, np.int64), _lists(wide, np.int64), _lists(numbers, np.int32),
        ], ["kind", "bucket", "doc", "wide", "number"])

    def count(table: pa.Table) -> pa.Table:
        kind, part = divmod(table.column("slot")[0].as_py(), parts)
        doc = _flat(table, "doc")
        if kind != RARE:
            return packed(kind, np.array([part]), [doc], [_flat(table, "wide")], [_flat(table, "number")])
        token = _flat(table, "token").view(np.uint32)
        order = np.lexsort((doc, token))
        token, doc = token[order], doc[order]
        new = np.append(True, (token[1:] != token[:-1]) | (doc[1:] != doc[:-1]))
        token, doc = token[new], doc[new]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(starts, len(token)))
        number = np.repeat(sizes, sizes).astype(np.int32)
        several = number > 1
        doc, number = doc[several], number[several]
        wide = token[several].astype(np.int64) | (part << 32)
        number += np.where(shared.value[wide >> (32 + bits - COUNT_BITS)] < low_below, 0, HIGH).astype(np.int32)
        buckets, cut = _cut(_numbered(doc.view(np.uint64), bits), doc, wide, number)
        return packed(RARE, buckets, *cut)

    return gathered.groupBy("slot").applyInArrow(count, "kind int, bucket int, doc array<long>, wide array<long>, number array<int>")


def _flat(table: pa.Table, column: str) -> np.ndarray:
    """All elements of a column of lists."""
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _prefix_entries(packed: DataFrame, nodes: DataFrame) -> DataFrame:
    """token, position, node, n: the shingles of each set's prefix that other sets have too.

    A set's order is: low shingles, others, common ones; the first two each begin with those that no other set sent and
    go on by the number of sets. What no other set sent needs no row; its number is what is left of the set's size. A task
    has all of a bucket's sets and chooses their prefixes in one pass over arrays.
    """

    def choose(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        doc, token, number = ({k: _flat(table.filter(pa.array(kind == k)), c) for k in (RARE, SIZES, COMMON)} for c in ("doc", "wide", "number"))
        names, first = np.unique(doc[SIZES], return_index=True)
        sizes, low_sizes = token[SIZES][first] & 0xFFFFFFFF, token[SIZES][first] >> 32
        rare_sizes = sizes - number[SIZES][first]
        order = np.lexsort((token[RARE], number[RARE], doc[RARE]))
        lo, wide, low = doc[RARE][order], token[RARE][order], number[RARE][order] < HIGH
        starts = np.flatnonzero(np.append(True, lo[1:] != lo[:-1])) if len(lo) else np.empty(0, np.int64)
        several = np.diff(np.append(starts, len(lo)))
        several_low = np.add.reduceat(low.astype(np.int64), starts) if len(lo) else several
        place = np.arange(len(lo)) - np.repeat(starts, several)
        at = np.searchsorted(names, lo)
        n = sizes[at]
        own = np.where(low, low_sizes[at] - np.repeat(several_low, several), rare_sizes[at] - np.repeat(several, several))
        position = own + place
        kept = position < n - (3 * n + 3) // 4 + 1
        # Equal sets have sent the same common shingles.
        once = np.lexsort((token[COMMON], doc[COMMON]))
        again = (np.diff(doc[COMMON][once], prepend=0) == 0) & (np.diff(token[COMMON][once], prepend=0) == 0)
        once = once[~again | (np.arange(len(once)) == 0)]
        lo = np.concatenate([lo[kept], doc[COMMON][once]])
        return pa.table({
            "lo": pa.array(lo), "token": pa.array(np.concatenate([wide[kept], token[COMMON][once]])),
            "position": pa.array(np.concatenate([position[kept], number[COMMON][once].astype(np.int64)])), "n": pa.array(sizes[np.searchsorted(names, lo)]),
        })

    chosen = packed.groupBy("bucket").applyInArrow(choose, "lo long, token long, position long, n long")
    return chosen.join(nodes.select("lo", "node"), "lo").select("token", "position", "node", "n")


def _wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """hi, lo, shingles of the sets in ``wanted`` (hi, lo), and of few others."""
    shared = docs.sparkSession.sparkContext.broadcast(flags(wanted, F.col("lo")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for _, sets in _texts(batches):
            hi, lo, found = [], [], []
            for s in sets:
                if not len(s):
                    continue
                high, low = fingerprint(s)
                if is_flagged(table, low):
                    hi.append(high), lo.append(low), found.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), _lists(found, np.int64)], ["hi", "lo", "shingles"]
            )

    return docs.mapInArrow(run, "hi long, lo long, shingles array<long>")


def _least_shared(n: Column, m: Column) -> Column:
    """What two sets of these sizes share at least when they link."""
    return F.ceil(3 * (n + m) / 7)


def _may_link(n: Column, m: Column, i: Column, j: Column) -> Column:
    """Length and positional filter on sets of n and m that have one shingle at positions i and j.

    The first shingle that two sets share leaves them no more to share than the shorter rest, so for sets that
    link it passes here. Later ones may not, and need not.
    """
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (F.least(n - i, m - j) >= _least_shared(n, m))


def _pairs(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs u > v of nodes that met, after the filter on spread.

    ``met``: node, n and the other's p_node, p_n. Of what two sets do not share, each range of hashes holds at
    least the difference of its two counts, also of counts that end at the same number.
    """
    up = F.col("node") > F.col("p_node")
    first = met.select(
        F.greatest("node", "p_node").alias("u"), F.least("node", "p_node").alias("v"),
        F.when(up, F.col("n")).otherwise(F.col("p_n")).alias("n"), F.when(up, F.col("p_n")).otherwise(F.col("n")).alias("m"),
    ).distinct()
    shared = _least_shared(F.col("n"), F.col("m"))
    x = nodes.select(F.col("node").alias("u"), F.col("spread").alias("x"))
    y = nodes.select(F.col("node").alias("v"), F.col("spread").alias("y"))
    apart = F.aggregate(F.zip_with("x", "y", lambda a, b: F.abs(a.cast("int") - b.cast("int"))), F.lit(0), lambda total, d: total + d)
    kept = first.join(x, "u").join(y, "v").filter(apart <= F.col("n") + F.col("m") - 2 * shared)
    return kept.select("u", "v", "n", "m")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, linked: each pair's sets meet once. ``pairs`` is a saved table; only sets that it has are shuffled."""
    one = sets.filter(flagged(F.xxhash64("node"), pairs, F.xxhash64("u"))).select(F.col("node").alias("u"), F.col("shingles").alias("x"))
    other = sets.filter(flagged(F.xxhash64("node"), pairs, F.xxhash64("v"))).select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    joined = pairs.join(one, "u").join(other, "v").select("u", "v", "n", "m", shared.alias("shared"))
    return joined.select("u", "v", (100 * F.col("shared") >= 75 * (F.col("n") + F.col("m") - F.col("shared"))).alias("linked"))


def _regrouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (node, root) after more links: the roots on both sides become one."""
    u = classes.select(F.col("node").alias("u"), F.col("root").alias("_u"))
    v = classes.select(F.col("node").alias("v"), F.col("root").alias("_v"))
    edges = links.join(u, "u").join(v, "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    moved = components(edges).select(F.col("node").alias("_old"), F.col("root").alias("_new"))
    merged = classes.join(moved, F.col("root") == F.col("_old"), "left")
    return saved(merged.select("node", F.coalesce("_new", "root").alias("root")))


def _pivots(over: Window | None = None, first: int = 0, columns=("node", "n", "position")) -> Column:
    """Some of the sets of a shingle, the same for most shingles of a group, as hashes of the node choose them.

    Half of them are taken among those that have the shingle at the lowest position, so the fewest shingles
    of their own: the least changed of a group of near copies, to which most others link.
    """
    chosen = []
    for k in range(PIVOTS):
        turn = F.xxhash64("node", F.lit(first + k))
        order = F.struct("position", turn, "node") if k % 2 == 0 else F.struct(turn, "node")
        pivot = F.min_by(F.struct(*columns), order)
        chosen.append(pivot.over(over) if over is not None else pivot)
    return F.array_distinct(F.array(*chosen))


def _meetings(entries: DataFrame) -> DataFrame:
    """Entries that can link: token, position, node, n, k (entries of the token) and its pivots.

    Sorted by size, an entry whose neighbours are both too small or too large has no partner at all. One sort
    by (token, n) serves both; a token is read as a stream, however many sets share it. If they are FEW, all are pivots.
    """
    by_size = Window.partitionBy("token").orderBy("n", "node")
    near = (4 * F.lag("n").over(by_size) >= 3 * F.col("n")) | (4 * F.col("n") >= 3 * F.lead("n").over(by_size))
    some = entries.withColumn("near", near).filter("near").drop("near").withColumn("place", F.row_number().over(by_size))
    token = Window.partitionBy("token")
    k = F.count("*").over(token)
    first = F.collect_list(F.when(F.col("place") <= FEW, F.struct("node", "n", "position"))).over(token)
    chosen = some.withColumns({"k": k, "pivots": F.when(k <= FEW, first).otherwise(_pivots(token))})
    return chosen.drop("place").filter("k > 1")


def _with_pivots(entries: DataFrame) -> DataFrame:
    """One row per entry and pivot of its token: p_node, p_n, p_position."""
    each = entries.withColumn("p", F.explode("pivots")).drop("pivots")
    return each.select("*", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("node", "n", "position")]).drop("p")


def _linkable() -> Column:
    return _may_link(F.col("n"), F.col("p_n"), F.col("position"), F.col("p_position"))


def _classes(live: DataFrame, total: int, failed: DataFrame, classes: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """node, root after all pairs of ``live`` entries (token, position, node, n), of which those in ``failed`` are known not to link."""
    for number in range(1, MAX_PIVOT_ROUNDS + 1):
        placed = live.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
        per_class = placed.groupBy("token", "root").agg(F.count("*").alias("k"))
        # Only shingles that still lie in several classes matter, now and in all rounds to come.
        mixed = per_class.groupBy("token").agg(
            F.count("*").alias("classes"), (F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("pairs")
        ).filter("classes > 1")
        placed = saved(placed.join(mixed.select("token", (F.col("pairs") / 2).alias("pairs")), "token"))
        between = placed.groupBy("token").agg(F.first("pairs").alias("pairs")).agg(F.sum("pairs")).first()[0] or 0
        if not between:
            break
        last = between <= PAIRS_PER_ENTRY * total or number == MAX_PIVOT_ROUNDS
        live = placed.select("token", "position", "node", "n")
        other = placed.select("token", "root", "node", "n", "position")
        if not last:
            chosen = _pivots(None, PIVOTS * number, ("root", "node", "n", "position"))
            other = other.groupBy("token").agg(chosen.alias("p")).select("token", F.inline("p"))
        other = other.toDF("p_token", *[f"p_{c}" for c in other.columns[1:]])
        meet = (F.col("token") == F.col("p_token")) & (F.col("root") != F.col("p_root")) & _linkable()
        if last:
            meet = meet & (F.col("node") > F.col("p_node"))
        pairs = saved(_pairs(placed.join(other, meet), nodes).join(failed, ["u", "v"], "left_anti"))
        checked = saved(_verified(pairs, sets))
        classes = _regrouped(classes, checked.filter("linked").select("u", "v"))
        if last:
            break
        failed = failed.unionByName(checked.filter("NOT linked").select("u", "v"))
    return classes


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """_id, _n_shingles, _component, _set of every row.

    Rows link when their sets of five-word shingles have a Jaccard similarity of 0.75 or more, and rows that
    links connect are one component, named by its smallest id. Equal sets are one set to the join, so copies
    cost nothing. A text of fewer than five words has its whole sequence as its only shingle; NULL
    and wordless texts have none and are components of their own. Repeated rows link like other copies; a
    NULL id takes part, and names a component (NULL) only if none of its rows has an id.
    """
    texts = in_small_batches(docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")))
    described = saved(_describe(texts))
    rows = described.filter("chunk IS NULL").select("_id", "n", "hi", "lo", "spread")
    rarity = _rarity(described)

    sets = rows.filter("n > 0").groupBy("hi", "lo").agg(F.first("n").alias("n"), F.first("spread").alias("spread"), F.min("_id").alias("first_id"))
    nodes = saved(sets.withColumn("node", F.monotonically_increasing_id()))

    total = described.agg(F.sum("n")).first()[0] or 0
    entries = saved(_meetings(_prefix_entries(_by_part(texts, rarity, total), nodes)))

    # Shingles of few sets are done with their pairs; those of more go on to further rounds.
    pairs = saved(_pairs(_with_pivots(entries).filter((F.col("node") != F.col("p_node")) & _linkable()), nodes))
    more = entries.filter(F.col("k") > FEW).select("token", "position", "node", "n")
    concerned = more.select("node").unionByName(pairs.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    wanted = saved(nodes.join(concerned, "node", "left_semi").select("hi", "lo", "node"))
    found = _wanted_sets(texts, wanted).groupBy("hi", "lo").agg(F.first("shingles").alias("shingles"))
    shingles = saved(found.join(wanted, ["hi", "lo"]).select("node", "shingles"))

    checked = saved(_verified(pairs, shingles))
    start = wanted.select("node", F.col("node").alias("root"))
    classes = _regrouped(start, checked.filter("linked").select("u", "v"))
    failed = checked.filter("NOT linked").select("u", "v")
    classes = _classes(more, entries.count(), failed, classes, nodes, shingles)

    placed = nodes.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = placed.groupBy("root").agg(F.min("first_id").alias("_component"))
    named = placed.join(names, "root").select("hi", "lo", "_component")
    joined = rows.filter("n > 0").join(named, ["hi", "lo"])
    alone = rows.filter("n = 0").withColumn("_component", F.col("_id"))
    both = joined.unionByName(alone, allowMissingColumns=True)
    return both.select("_id", F.col("n").alias("_n_shingles"), "_component")
