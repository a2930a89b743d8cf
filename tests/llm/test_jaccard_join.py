from __future__ import annotations

import random

import numpy as np
import pytest

from skyledger.llm import jaccard_join
from skyledger.llm.components import components
from skyledger.llm.shingles import PIECE_BYTES, shingle_sets, word_hashes
from tests.llm.support import ODD_ROWS, documents, linked_components, shingles


def near_copies(seed, groups=12, size=14):
    """Groups of texts with words exchanged, some within the threshold and some not, and lone texts."""
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(groups):
        base = pick.choices(vocabulary, k=pick.choice([3, 5, 8, 30, 80]))
        for _ in range(pick.randint(1, size)):
            words = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 3])):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(words) + pick.choice(["", " ", "\n"])))
    return rows


def found(table):
    return {r._id: (r._n_shingles, r._component) for r in jaccard_join.similar_documents(table).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = near_copies(seed)
    table = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert found(table) == linked_components(rows)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == linked_components(rows)


def test_a_group_of_near_copies_needs_no_square_of_pairs(spark, monkeypatch):
    """Later rounds with pivots, and a last one, find what a comparison of all pairs finds."""
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_ENTRY", 0)
    monkeypatch.setattr(jaccard_join, "MAX_PIVOT_ROUNDS", 2)
    pick = random.Random(5)
    base = [f"v{k}" for k in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(pick.randint(1, 4)):
            words[pick.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert found(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])) == linked_components(rows)


def test_common_shingles_can_link(spark, monkeypatch):
    """With a count table that takes every shingle for common, the same links come from its order alone."""
    monkeypatch.setattr(jaccard_join, "_common_from", lambda total: 0)
    rows = near_copies(3)
    assert found(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])) == linked_components(rows)


@pytest.mark.parametrize("count", [1, 2, 6])
def test_low_shingles_come_first(spark, monkeypatch, count):
    """Wherever the low shingles end, so that some sets send only these and others all, the links are the same."""
    below = int(np.round(np.log2(1.0 + count) * 512)) + 1
    monkeypatch.setattr(jaccard_join, "_low_below", lambda rarity, common_from: below)
    rows = near_copies(6)
    assert found(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])) == linked_components(rows)


def test_most_shingles_are_not_sent():
    """Of a table that is full, sets send about the lower two fifths, which hold their prefix."""
    counts = np.random.default_rng(1).poisson(20, 1 << jaccard_join.COUNT_BITS)
    rarity = np.round(np.log2(1.0 + counts) * 512).astype(np.uint16)
    common_from = jaccard_join._common_from(int(counts.sum()))
    low_below = jaccard_join._low_below(rarity, common_from)
    tokens = np.repeat(np.arange(len(counts)), counts)
    for n in (5, 60, 400, 3000):
        rank = rarity[np.random.default_rng(n).choice(tokens, n)]
        sent = jaccard_join._sent(rank, low_below, common_from)
        low = rank < low_below
        assert sent[low].all() and not sent[rank >= common_from].any()
        assert sent.sum() >= jaccard_join.prefix_length(n) and (n < 400 or sent.sum() < 0.55 * n)
    assert jaccard_join._sent(np.full(8, low_below), low_below, common_from).all()


def test_many_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_BYTES", 2000)
    rows = near_copies(4)
    assert found(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])) == linked_components(rows)


def test_odd_rows(spark):
    table = documents(spark, ODD_ROWS, n=1, node="x", _id=5, position=2.0)
    rows = sorted(((r._id, r._n_shingles, r._component) for r in jaccard_join.similar_documents(table).collect()), key=str)
    expected = sorted(((i, len(shingles(t)), i) for i, t, *_ in ODD_ROWS), key=str)
    assert rows == expected
    assert jaccard_join.similar_documents(documents(spark, [])).collect() == []


def test_threshold_is_met_exactly(spark):
    # Six of eight shingles shared, then five of nine.
    a = " ".join("abcdefghijk")
    rows = [(1, a), (2, a + " x"), (3, "q " + a + " x"), (4, "a b c d"), (5, "a b c d"), (6, "a b c d e")]
    assert found(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])) == linked_components(rows)


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = ["Some words here", None, "", "  many\twords " * 50, "ÄÖ x" * 30, "y" * 500]
    whole = [list(h) for h in word_hashes(texts)]
    monkeypatch.setattr("skyledger.llm.shingles.PIECE_BYTES", 64)
    assert [list(h) for h in word_hashes(texts)] == whole
    assert PIECE_BYTES > 64
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    assert np.array_equal(next(shingle_sets(["A B C D E"])), next(shingle_sets(["a\nb  c d e "])))


def test_components(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(1, k) for k in range(2, 30)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (3, 2), (2, 3)], "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{k: 100 for k in range(100, 141)}, **{k: 1 for k in range(1, 30)}}
    assert components(edges.limit(0)).collect() == []
