import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import merkle
from tests.llm.support import ODD_ROWS, documents


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    return h(*(field(v) for v in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, slot):
    """Each level's sibling with its place, or None."""
    found = []
    for level in levels[:-1]:
        other = slot ^ 1
        found.append((other < slot, level[other]) if other < len(level) else None)
        slot >>= 1
    return found


def fold(node, path):
    for step in path:
        node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
    return node


def plain_manifest(rows, tampered=lambda row: False):
    """(id, leaf, subroot, root, hash of the siblings, folded) of each row."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = levels_of([plain_leaf(r) for r in groups[name]])
    top = levels_of([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for slot, row in enumerate(groups[name]):
            path = siblings(trees[name], slot) + siblings(top, place)
            leaf = plain_leaf(row)
            used = plain_leaf((*row[:4], None if row[4] is None else row[4] + 1)) if tampered(row) else leaf
            found.append((row[0], leaf, trees[name][-1][0], top[-1][0], h(*(s[1] for s in path if s)), fold(used, path)))
    return Counter(found)


def manifest(docs, **options):
    rows = merkle.merkle_manifest(docs, **options).collect()
    for r in rows:
        assert r._verified == (r._folded == r._root) and merkle.folded(r._leaf, r._proof) == r._root
    return Counter((r.doc_id, r._leaf, r._subroot, r._root, r._proof_sha256, r._folded) for r in rows)


def make_rows(seed, n, span):
    rng = random.Random(seed)
    return [(i, f"text {i}", rng.choice(["de", "en", "en", "en", None, "é"]), rng.choice("ab"), i % 9) for i in rng.sample(range(-span, span), n)]


@pytest.mark.parametrize("n, span", [(1, 5), (2, 5), (7, 50), (2500, 2000), (300, 1 << 40)])
def test_places_and_proofs_are_those_of_sorted_leaves(spark, n, span):
    rows = make_rows(n, n, span)
    docs = documents(spark, rows).repartition(3)
    more = merkle.leaf_hash("doc_id", "source", "lang", F.col("n_chars") + 1, "text")
    found = manifest(docs, tampered=F.when(F.col("doc_id") % 3 == 0, more))
    assert found == plain_manifest(rows, lambda r: r[0] % 3 == 0)


def test_rows_that_share_a_key_go_by_their_leaf(spark):
    rows = make_rows(5, 400, 300)
    shared = [(7, f"other {k % 5}", "en", "s", 1) for k in range(300)] + [(None, "none", "en", None, None)] * 40
    docs = documents(spark, rows + shared)
    expected = plain_manifest(rows + shared)
    assert manifest(docs.repartition(5)) == expected == manifest(docs.coalesce(1))


def test_odd_rows_have_defined_results(spark):
    names = dict.fromkeys(["_row", "_group", "_key", "row", "g", "slot", "tampered", "node", "_leaf", "_total"], "x")
    docs = documents(spark, ODD_ROWS * 2, **names)
    assert manifest(docs, keep=[c for c in docs.columns]) == plain_manifest(ODD_ROWS * 2)
    assert merkle.merkle_manifest(docs.filter("false")).collect() == []


def test_bitmaps_rank_dense_and_repeated_keys():
    rng = np.random.default_rng(1)
    for n in (1, 50, 5000, 60_000):
        keys = np.sort(rng.choice(1 << 16, n, replace=False))
        counts = rng.integers(1, 4, n)
        assert (merkle._unpacked(merkle._packed(keys)) == keys).all()
        chunk = merkle._Chunk(merkle._packed(keys), counts.astype(np.int64).tobytes(), 100, 0)
        rank, tied = chunk.rank(keys)
        assert (rank == 100 + np.cumsum(counts) - counts).all() and (tied == (counts > 1)).all()


def test_containers_of_many_batches_merge_to_one_chunk():
    rng = np.random.default_rng(2)
    keys = rng.integers(-100_000, 100_000, 30_000)
    batches = [pa.RecordBatch.from_arrays([pa.array(["g"] * 1000), pa.array(part)], ["g", "key"]) for part in keys.reshape(-1, 1000)]
    sent = pa.concat_tables([pa.Table.from_batches([b]) for b in merkle._containers(iter(batches))]).sort_by([("g", "ascending"), ("chunk", "ascending")])
    merged = pa.Table.from_batches(list(merkle._merged_chunks(iter(sent.to_batches(max_chunksize=7)))))
    assert merged.column("n").to_pylist() == list(np.unique(keys >> 16, return_counts=True)[1])
    assert sum(len(merkle._unpacked(k)) for k in merged.column("keys").to_pylist()) == len(np.unique(keys))


def test_no_leaf_is_sorted_by_its_key(spark):
    docs = documents(spark, make_rows(1, 50, 100))
    rows = docs.select(F.col("doc_id").alias("_key"), F.monotonically_increasing_id().alias("row"))
    plan = merkle.ranked(rows, F.lit("g"), F.col("_key"))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Sort [" in line and "_below" in line]
    assert sorts and all("_key" not in line for line in sorts)
