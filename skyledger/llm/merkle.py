"""A manifest of a dataset as Merkle trees, one per group of rows and one over the groups, with a proof per row.

A leaf's place in its group is the rank of its key in the group's bitmap. Bitmaps are cut into chunks of
65,536 keys. Tasks send the keys that they see as compressed containers, which are merged per chunk; a running
sum over the chunks' counts is the directory, and a popcount directory inside each chunk answers where a key
lies. So leaves are never sorted. Nodes are then reduced by block: up to 1,024 nodes take their slots in an
array and climb ten levels in one task, so the number of rounds is the logarithm of the rows to base 1,024.
Paths come back down the same blocks.

Rows that share a key are placed among themselves by the same ranking, of their leaf's leading bits and then
of a written row number, which only tells apart rows of one leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import saved

CHUNK_BITS = 16
BLOCK_BITS = 10
# A chunk's bitmap is sent to so many tasks, which share its rows, should one key have very many.
SALTS = 4
# Keys that are gathered before they are counted, while a chunk is merged.
PENDING = 1 << 20
# A container with fewer keys lists them in two bytes each, others are a bitmap of 8 KB.
LISTED = 4096
# A path has for each level a side (NONE: no sibling) and the sibling's 32 bytes.
NONE, LEFT, RIGHT = range(3)
STEP = 33
LEAST_KEY = -(1 << 63)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(column: str | Column) -> Column:
    """A value as its byte count, a colon and its text; ``-`` if NULL."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: str | Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# ---------------------------------------------------------------------------
# Ranks
# ---------------------------------------------------------------------------


def _counted(lows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk, ascending, with their counts."""
    keys, where = np.unique(lows, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, where, counts)
    return keys, sums


def _packed(lows: np.ndarray) -> bytes:
    """A container: the ascending keys, or a bitmap of them if they are many."""
    if len(lows) < LISTED:
        return lows.astype(np.uint16).tobytes()
    bits = np.zeros(1 << CHUNK_BITS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _unpacked(container: bytes) -> np.ndarray:
    if len(container) < 2 * LISTED:
        return np.frombuffer(container, np.uint16).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group and chunk of a batch: keys, repeats (counts of keys, if any is not one)."""
    for batch in batches:
        encoded = batch.column(0).dictionary_encode()
        groups, names = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        keys = batch.column(1).to_numpy()
        order = np.lexsort((keys, groups))
        groups, keys = groups[order], keys[order]
        chunks = keys >> CHUNK_BITS
        starts = np.flatnonzero(np.append(True, (groups[1:] != groups[:-1]) | (chunks[1:] != chunks[:-1]))) if len(keys) else np.empty(0, np.int64)
        containers, repeats = [], []
        for start, end in zip(starts, np.append(starts[1:], len(keys))):
            lows, counts = np.unique(keys[start:end] & 0xFFFF, return_counts=True)
            containers.append(_packed(lows))
            repeats.append(counts.astype(np.int64).tobytes() if counts.max() > 1 else b"")
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(groups[starts])), pa.array(chunks[starts], pa.int64()), pa.array(containers, pa.binary()), pa.array(repeats, pa.binary())],
            ["g", "chunk", "keys", "repeats"],
        )


def _merged_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group and chunk of sorted containers: keys, repeats of all of them, n (rows)."""
    name, pending, size, found = None, [], 0, []

    def gather() -> tuple[np.ndarray, np.ndarray]:
        return _counted(np.concatenate([k for k, _ in pending]), np.concatenate([c for _, c in pending]))

    def close() -> None:
        keys, counts = gather()
        found.append((*name, _packed(keys), counts.tobytes() if counts.max() > 1 else b"", int(counts.sum())))

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], ["g", "chunk", "keys", "repeats", "n"])

    for batch in batches:
        for g, chunk, container, repeats in zip(*(c.to_pylist() for c in batch.columns)):
            if name != (g, chunk):
                if name is not None:
                    close()
                name, pending, size = (g, chunk), [], 0
            keys = _unpacked(container)
            pending.append((keys, np.frombuffer(repeats, np.int64) if repeats else np.ones(len(keys), np.int64)))
            size += len(keys)
            if size > PENDING:
                pending = [gather()]
                size = len(pending[0][0])
        yield batch_of()
        found.clear()
    if name is not None:
        close()
        yield batch_of()


class _Chunk:
    """A chunk's bitmap with its popcount directory."""

    def __init__(self, container: bytes, repeats: bytes, offset: int, total: int) -> None:
        keys = _unpacked(container)
        self.words = np.zeros(1 << (CHUNK_BITS - 6), np.uint64)
        np.bitwise_or.at(self.words, keys >> 6, np.uint64(1) << (keys & 63).astype(np.uint64))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        counts = np.frombuffer(repeats, np.int64) if repeats else np.ones(len(keys), np.int64)
        self.repeated = keys[counts > 1]
        self.more = np.concatenate(([0], np.cumsum(counts[counts > 1] - 1)))
        self.offset, self.total = offset, total

    def rank(self, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the rows of the group below it, and whether it is repeated."""
        word = lows >> 6
        below = (np.uint64(1) << (lows & 63).astype(np.uint64)) - np.uint64(1)
        at = np.searchsorted(self.repeated, lows)
        rank = self.offset + self.before[word] + np.bitwise_count(self.words[word] & below) + self.more[at]
        tied = np.append(self.repeated, -1)[at] == lows
        return rank.astype(np.int64), tied


def running_sums(table: DataFrame, group: str, order: Sequence[str], amount: str) -> DataFrame:
    """The table with _before (the amounts of the group's earlier rows) and _total (of all its rows), written.

    Rows are range-partitioned; each partition adds up its own, and a small table has what lies before it. So no
    task holds a whole group.
    """
    laid = saved(table.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()))
    sums = laid.groupBy(group, "_part").agg(F.sum(amount).alias("_sum"))
    whole = Window.partitionBy(group)
    sums = sums.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"),
        (F.sum("_sum").over(whole.orderBy("_part")) - F.col("_sum")).alias("_earlier"), F.sum("_sum").over(whole).alias("_total"),
    )
    inside = F.sum(amount).over(Window.partitionBy(group, "_part").orderBy(*order)) - F.col(amount)
    placed = laid.withColumn("_inside", inside).join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return placed.withColumn("_before", F.col("_earlier") + F.col("_inside")).drop("_part", "_inside", "_g", "_p", "_earlier")


def ranked(rows: DataFrame, group: Column, key: Column) -> DataFrame:
    """Rows (with a number ``row``) and _rank (rows of the group with a smaller key), _tied (its key is repeated), _total (rows of the group)."""
    keyed = rows.withColumns({"_g": group, "_key": key})
    sent = keyed.select("_g", "_key").mapInArrow(_containers, "g string, chunk long, keys binary, repeats binary")
    sent = sent.repartition("g", "chunk").sortWithinPartitions("g", "chunk")
    chunks = sent.mapInArrow(_merged_chunks, "g string, chunk long, keys binary, repeats binary, n long")
    directory = running_sums(chunks, "g", ["chunk"], "n")

    heads = directory.select(
        F.col("g").alias("_g"), F.col("chunk").alias("_chunk"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
        F.lit(False).alias("_below"), "keys", "repeats", F.col("_before").alias("_rank"), "_total",
    )
    placed = keyed.withColumns({
        "_chunk": F.shiftright("_key", CHUNK_BITS), "_salt": F.pmod("row", F.lit(SALTS)).cast("int"), "_below": F.lit(True),
    })
    both = placed.unionByName(heads, allowMissingColumns=True)
    dealt = both.repartition("_g", "_chunk", "_salt").sortWithinPartitions("_g", "_chunk", "_salt", "_below")
    added = rows.select("*", F.lit(0).cast("long").alias("_rank"), F.lit(False).alias("_tied"), F.lit(0).cast("long").alias("_total")).schema
    names = rows.columns
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in batches:
            below = batch.column("_below").to_numpy(zero_copy_only=False)
            lows = np.where(below, batch.column("_key").fill_null(0).to_numpy() & 0xFFFF, 0)
            rank, tied, total = np.zeros(len(lows), np.int64), np.zeros(len(lows), bool), np.zeros(len(lows), np.int64)
            heads = np.flatnonzero(~below)
            for start, end in zip(np.append(-1, heads), np.append(heads, len(lows))):
                if start >= 0:
                    chunk = _Chunk(*(batch.column(c)[start].as_py() for c in ("keys", "repeats", "_rank", "_total")))
                if end > start + 1:
                    part = slice(start + 1, end)
                    rank[part], tied[part] = chunk.rank(lows[part])
                    total[part] = chunk.total
            whole = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(rank), pa.array(tied), pa.array(total)], schema=arrow)
            yield whole.filter(pa.array(below))

    return dealt.mapInArrow(run, added)


def placed_leaves(rows: DataFrame) -> DataFrame:
    """Rows (row, _group, _key, _leaf, ...) with _slot, the leaf's place in its group, and _total, the group's leaves."""
    group = field("_group")
    steps = [
        (group, F.coalesce("_key", F.lit(LEAST_KEY))),
        (F.concat(group, F.lit("|"), field("_key")), F.conv(F.substring("_leaf", 1, 15), 16, 10).cast("long")),
        (F.concat(group, F.lit("|"), field("_key"), F.lit("|"), F.substring("_leaf", 1, 15)), F.col("row")),
    ]
    done, rest = [], rows.withColumn("_slot", F.lit(0).cast("long"))
    for number, (group, key) in enumerate(steps):
        found = saved(ranked(rest, group, key).withColumn("_slot", F.col("_slot") + F.col("_rank")))
        if number == 0:
            found = found.withColumn("_size", F.col("_total"))
        found = found.drop("_rank", "_total")
        done.append(found.filter("NOT _tied").drop("_tied"))
        rest = found.filter("_tied").drop("_tied")
        if rest.isEmpty():
            break
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.withColumnRenamed("_size", "_total")


# ---------------------------------------------------------------------------
# Levels
# ---------------------------------------------------------------------------


def _climbed(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of a block, its nodes first: ten, or in a tree of one block as many as lead to its root."""
    levels = [nodes]
    for _ in range(min(BLOCK_BITS, (total - 1).bit_length())):
        below = levels[-1]
        levels.append([_hash("".join(below[at : at + 2])) for at in range(0, len(below), 2)])
    return levels


def _slots(table: pa.Table) -> tuple[np.ndarray, list[str]]:
    """Each row's slot in its block, and the block's nodes by slot."""
    slots = table.column("slot").to_numpy() & ((1 << BLOCK_BITS) - 1)
    nodes = [""] * len(slots)
    for slot, node in zip(slots, table.column("node").to_pylist()):
        nodes[slot] = node
    return slots, nodes


def _block() -> Column:
    return F.shiftright("slot", BLOCK_BITS)


def _reduced(nodes: DataFrame) -> DataFrame:
    """g, slot, total, node of the blocks of nodes (g, slot, total, node)."""

    def reduce(table: pa.Table) -> pa.Table:
        total = table.column("total")[0].as_py()
        root = _climbed(_slots(table)[1], total)[-1][0]
        block = table.column("slot")[0].as_py() >> BLOCK_BITS
        above = ((total - 1) >> BLOCK_BITS) + 1
        return pa.table({"g": table.column("g").slice(0, 1).combine_chunks(), "slot": pa.array([block], pa.int64()), "total": pa.array([above], pa.int64()), "node": [root]})

    blocks = nodes.select("g", "slot", "total", "node", _block().alias("block")).groupBy("g", "block")
    return blocks.applyInArrow(reduce, "g string, slot long, total long, node string")


def rounds_of(leaves: DataFrame) -> list[DataFrame]:
    """The nodes (g, slot, total, node) at every tenth level, each written; the last round has only roots."""
    rounds = [leaves]
    while not (rest := rounds[-1].filter("total > 1")).isEmpty():
        rounds.append(saved(_reduced(rest)))
    return rounds


def roots_of(rounds: list[DataFrame]) -> DataFrame:
    """g, node: the root of each group's tree."""
    roots = rounds[0].filter("total = 1").select("g", "node")
    for nodes in rounds[1:]:
        roots = roots.unionByName(nodes.filter("total = 1").select("g", "node"))
    return roots


def _siblings(levels: list[list[str]], slot: int) -> bytes:
    """A node's path from its block's first level to its last."""
    path = []
    for level in levels[:-1]:
        other = slot ^ 1
        if other >= len(level):
            path.append(bytes(STEP))
        else:
            path.append(bytes([LEFT if other < slot else RIGHT]) + bytes.fromhex(level[other]))
        slot >>= 1
    return b"".join(path)


def _steps(path: bytes) -> list[tuple[int, str]]:
    return [(path[at], path[at + 1 : at + STEP].hex()) for at in range(0, len(path), STEP)]


def folded(node: str, path: bytes) -> str:
    """What a node gives with the siblings of its path."""
    for side, other in _steps(path):
        node = _hash(node if side == NONE else other + node if side == LEFT else node + other)
    return node


def _blocks(nodes: DataFrame, above: DataFrame) -> tuple[GroupedData, GroupedData]:
    """Nodes by block, and each block's row of ``above``, under names of its own as both may come from one table."""
    uppers = above.select(*[F.col(c).alias(c) for c in above.columns], F.col("slot").alias("block"))
    return nodes.withColumn("block", _block()).groupBy("g", "block"), uppers.groupBy("g", "block")


def _descended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """g, slot, path, subroot, root of all nodes, from those of their blocks."""

    def descend(below: pa.Table, upper: pa.Table) -> pa.Table:
        slots, hashes = _slots(below)
        levels = _climbed(hashes, below.column("total")[0].as_py())
        rest = upper.column("path")[0].as_py()
        ends = [pa.array([upper.column(c)[0].as_py()] * len(slots), pa.string()) for c in ("subroot", "root")]
        return pa.table([below.column("g"), below.column("slot"), pa.array([_siblings(levels, s) + rest for s in slots], pa.binary()), *ends], ["g", "slot", "path", "subroot", "root"])

    left, right = _blocks(nodes, above)
    return left.cogroup(right).applyInArrow(descend, "g string, slot long, path binary, subroot string, root string")


def _paths_above(rounds: list[DataFrame], starts: DataFrame) -> DataFrame:
    """g, slot, path, subroot, root of the blocks of the first round. ``starts``: g, path, subroot, root of each group's root."""

    def tops(nodes: DataFrame) -> DataFrame:
        return nodes.filter("total = 1").select("g", F.lit(0).cast("long").alias("slot")).join(starts, "g")

    above = None
    for nodes in reversed(rounds[1:]):
        known = tops(nodes)
        if above is not None:
            known = known.unionByName(_descended(nodes.filter("total > 1"), above))
        above = saved(known)
    # A leaf that is its group's root is a block of no levels.
    return tops(rounds[0]) if above is None else above.unionByName(tops(rounds[0]))


def _verified(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """_row, _leaf, _slot, _subroot, _root, _proof (path), _proof_sha256, _folded, _verified of every leaf."""
    row = leaves.schema["_row"]
    schema = f"_row {row.dataType.simpleString()}, _leaf string, _slot long, _subroot string, _root string, _proof binary, _proof_sha256 string, _folded string, _verified boolean"
    arrow = to_arrow_schema(leaves.select(
        "_row", F.lit("").alias("_leaf"), F.lit(0).cast("long").alias("_slot"), F.lit("").alias("_subroot"), F.lit("").alias("_root"),
        F.lit(b"").alias("_proof"), F.lit("").alias("_proof_sha256"), F.lit("").alias("_folded"), F.lit(True).alias("_verified"),
    ).schema)

    def verify(below: pa.Table, upper: pa.Table) -> pa.Table:
        slots, hashes = _slots(below)
        levels = _climbed(hashes, below.column("total")[0].as_py())
        rest, subroot, root = (upper.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        rest_text = "".join(other for side, other in _steps(rest) if side != NONE)
        ends: dict[str, str] = {}
        proofs, digests, results = [], [], []
        for slot, leaf, tampered in zip(slots, below.column("node").to_pylist(), below.column("tampered").to_pylist()):
            inner = _siblings(levels, slot)
            top = folded(tampered or leaf, inner)
            if top not in ends:
                ends[top] = folded(top, rest)
            proofs.append(inner + rest)
            digests.append(_hash("".join(other for side, other in _steps(inner) if side != NONE) + rest_text))
            results.append(ends[top])
        n = len(slots)
        return pa.table([
            below.column("_row"), below.column("node"), below.column("slot"), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
            pa.array(proofs, pa.binary()), pa.array(digests, pa.string()), pa.array(results, pa.string()), pa.array([r == root for r in results], pa.bool_()),
        ], schema=arrow)

    left, right = _blocks(leaves, above)
    return left.cogroup(right).applyInArrow(verify, schema)


def merkle_manifest(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    group: str = "lang",
    key: str = "doc_id",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: Column | None = None,
) -> DataFrame:
    """The ``keep`` columns, and _leaf, _slot, _subroot, _root, _proof, _proof_sha256, _folded, _verified of every row.

    A leaf is the hash of a row's ``fields``. A group's leaves ascend by ``key``, a whole number; while several
    nodes remain, every two consecutive ones, or a last one alone, become their hash. The groups' roots, by name, are
    reduced likewise. NULL is a group and the first; a NULL key comes before all others. Rows of one key go by their leaves' hash,
    so the root does not depend on how rows lie in files. ``_proof`` has a byte and a sibling per level (see ``folded``);
    ``_folded`` is what it gives for ``tampered``, a leaf hash to verify in place of the row's own where it is not NULL.
    Input columns may have any name but those of the result, which replace them. No rows, no result.
    """
    names = ("_leaf", "_slot", "_subroot", "_root", "_proof", "_proof_sha256", "_folded", "_verified")
    rows = saved(docs.select(
        F.struct(*[F.col(c) for c in keep if c not in names]).alias("_row"),
        F.col(group).cast("string").alias("_group"), F.col(key).cast("long").alias("_key"),
        leaf_hash(*fields).alias("_leaf"), (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    ))
    placed = placed_leaves(rows)
    leaves = saved(placed.select("_row", "_group", field("_group").alias("g"), F.col("_slot").alias("slot"), F.col("_total").alias("total"), F.col("_leaf").alias("node"), "tampered"))
    rounds = rounds_of(leaves.select("g", "slot", "total", "node"))
    named = roots_of(rounds).join(leaves.filter("slot = 0").select("g", "_group"), "g")
    numbered = running_sums(named.withColumns({"tree": F.lit(""), "one": F.lit(1).cast("long")}), "tree", ["_group"], "one")
    numbered = saved(numbered.select("g", "node", F.col("_before").alias("slot"), F.col("_total").alias("total")))

    top_rounds = rounds_of(numbered.select(F.lit("").alias("g"), "slot", "total", "node"))
    root = roots_of(top_rounds).select("g", F.lit(b"").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    whole = _descended(top_rounds[0], _paths_above(top_rounds, root))
    starts = saved(numbered.join(whole.select("slot", "path", "root"), "slot").select("g", "path", F.col("node").alias("subroot"), "root"))
    return _verified(leaves, _paths_above(rounds, starts)).select("_row.*", *names)
