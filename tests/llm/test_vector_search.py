from __future__ import annotations

import numpy as np
import pytest

from skyledger.llm import vector_search as vs

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=20):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    answer = {}
    for q, x in ok:
        if q % 20 == 0:
            others = sorted(((-float(np.dot(x, y)), i) for i, y in ok if i != q and len(y) == len(x)))
            answer[q] = [(i, -s) for s, i in others[:k]]
    return answer


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def found(frame):
    answer = {}
    for r in sorted(vs.nearest(frame).collect(), key=lambda r: (r.query_id, r.rank)):
        answer.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(answer[r.query_id])
    return answer


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_recall(spark, spread, monkeypatch):
    """Recall against brute force on random vectors, and on near copies of few."""
    monkeypatch.setattr(vs, "VECTOR_BLOCK_BYTES", 150_000)
    monkeypatch.setattr(vs, "QUERY_BLOCK_BYTES", 8_000)
    random = np.random.default_rng(3)
    base = random.standard_normal((8, 64))
    rows = [(i, np.float32(base[i % 8] + spread * random.standard_normal(64))) for i in range(1500)]
    expected, answer = plain(rows), found(table(spark, rows))
    assert answer.keys() == expected.keys()
    hits = sum(len({i for i, _ in answer[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / sum(map(len, expected.values())) >= 0.98


@pytest.mark.parametrize("size", [1e200, 1e150, 1e-150, 1e-200, 1e307, 5e-324])
def test_vectors_of_any_finite_size_are_found(spark, size):
    """Products that a double holds are ranked right; those beyond it are infinite, or zero and ranked by id."""
    random = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.clip(random.standard_normal(64), -2, 2) * size]) for i in range(60)]
    rows = [(i, v) for i, v in rows if any(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    answer = found(frame)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = {q: {i: float(np.einsum("ij,j->i", np.array([w]), np.array(v))[0]) for i, w in rows if i != q} for q, v in rows if q % 20 == 0}
    assert answer.keys() == scores.keys()
    for q, near in answer.items():
        assert len(near) == 20 and all(s == scores[q][i] or (s is None and np.isnan(scores[q][i])) for i, s in near)
        if 1e-150 <= size <= 1e150:
            best = sorted(scores[q], key=lambda i: (-scores[q][i], i))[:20]
            assert len(set(best) & {i for i, _ in near}) >= 19
        elif size < 1e-150:
            assert [i for i, _ in near] == sorted(scores[q], key=lambda i: (-scores[q][i], i))[:20]


def test_given_vectors(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected, answer = plain([(r.vec_id, r.embedding) for r in frame.collect()]), found(frame)
    hits = sum(len({i for i, _ in answer[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.98 * sum(map(len, expected.values()))
    scores = {(q, i): s for q, near in expected.items() for i, s in near}
    assert all(s == pytest.approx(scores[q, i], rel=1e-12) for q, near in answer.items() for i, s in near if (q, i) in scores)


def test_estimates_are_unbiased_and_bounded():
    random = np.random.default_rng(1)
    x, y = random.standard_normal((2000, 64)), random.standard_normal((50, 64))
    guess, width = vs.estimate(y, vs.rotation(64), *vs.encode(x, vs.rotation(64)))
    error = guess - y @ x.T
    assert abs(error.mean()) < 0.05
    assert (np.abs(error) <= width).mean() > 0.99


def test_odd_rows(spark):
    unit = [1.0, 0.0, 0.0]
    rows = [(0, unit), (20, unit), (1, unit), (2, unit), (3, [0.0] * 3), (4, None), (5, [1.0, None, 0.0]), (6, [float("nan"), 1, 0]), (7, [float("inf"), 1, 0]),
            (None, unit), (40, [1.0, 2.0]), (8, [2.0, 1.0]), (60, [0.0, 0.0, 0.0]), (9, [-1.0, 0, 0]), (2, unit), (10, [])]
    answer = found(table(spark, rows))
    assert set(answer) == {0, 20, 40}
    assert answer[0] == [(1, 1.0), (2, 1.0), (2, 1.0), (20, 1.0), (9, -1.0)]
    assert answer[40] == [(8, 4.0)]
    assert vs.nearest(table(spark, rows).limit(0)).collect() == []
