"""Nearest vectors by inner product, with randomly rotated one-bit codes.

Every vector, brought to length 1 and rotated at random, is kept as the signs of its components, one bit
each, and two numbers: its length, and how well the signs agree with it. From these follow an unbiased
estimate of an inner product and an error bound that fails rarely. A block of queries meets a block of
vectors: estimates for all of them come from the packed bits, and only vectors whose upper bound reaches
the 20th best lower bound are compared in full, in double precision.

The query set meets all vectors in blocks, so the work is their product; codes make each meeting cheap.
Block sizes are fixed, whatever the input, and every pair of blocks is one task's bounded work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import in_small_batches, saved

NEAREST = 20
QUERY_EVERY = 20
# Bytes of a block as doubles: at 64 components 16,384 vectors, and 4,096 queries. A vector is sent once per block of
# queries, a query once per block of vectors.
VECTOR_BLOCK_BYTES = 8 << 20
QUERY_BLOCK_BYTES = 2 << 20
# Queries whose estimates are held at once.
QUERIES_AT_ONCE = 64
# Half-widths of the error bound, in standard deviations of the estimate.
BOUND = 3.0
SEED = 7


@lru_cache(maxsize=4)
def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix; the same for the same size."""
    gaussian = np.random.default_rng(seed).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(gaussian)
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length, and agreement (inner product of the rotated unit vector with its signs, scaled to length 1)."""
    # By the largest component first, whose square may be beyond what a double holds.
    largest = np.abs(vectors).max(axis=1)
    scaled = vectors / largest[:, None]
    lengths = np.linalg.norm(scaled, axis=1)
    rotated = (scaled / lengths[:, None]) @ turn
    agreement = np.abs(rotated).sum(axis=1) / np.sqrt(vectors.shape[1])
    with np.errstate(over="ignore"):
        return np.packbits(rotated > 0, axis=1), lengths * largest, agreement


def estimate(queries: np.ndarray, turn: np.ndarray, bits: np.ndarray, lengths: np.ndarray, agreement: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries with coded vectors, and the half-width of their bounds."""
    d = queries.shape[1]
    rotated = queries @ turn
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32)
    # With bits b in {0, 1} the signs are 2 b - 1.
    product = (2 * (rotated.astype(np.float32) @ signs.T) - rotated.sum(axis=1, keepdims=True)) / np.sqrt(d)
    scale = lengths / agreement
    spread = np.sqrt(np.maximum(1 - agreement**2, 0)) / np.sqrt(max(d - 1, 1))
    return product * scale, BOUND * np.linalg.norm(queries, axis=1)[:, None] * (scale * spread)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def search_block(query_ids, queries, ids, vectors, bits, lengths, agreement, turn, k: int = NEAREST):
    """For each query its k best vectors of this block but itself: lists of (query, id, score)."""
    out_q, out_v, out_s = [], [], []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[at : at + QUERIES_AT_ONCE]
        # Bounds of one query are compared with each other only, so its length does not matter.
        with np.errstate(over="ignore", invalid="ignore"):
            guess, width = estimate(some / np.abs(some).max(axis=1, keepdims=True), turn, bits, lengths, agreement)
            upper, lower = guess + width, guess - width
        for row in range(len(some)):
            other = ids != query_ids[at + row]
            floor = np.nan_to_num(lower[row][other], nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            kth = np.partition(floor, len(floor) - k)[len(floor) - k] if len(floor) > k else -np.inf
            # A bound that is no number rules nothing out.
            near = np.flatnonzero(other & ~(upper[row] < kth))
            with np.errstate(over="ignore", invalid="ignore"):
                scores = np.einsum("ij,j->i", vectors[near], some[row])
            best = _best(ids[near], scores, k)
            out_q.append(np.full(len(best), query_ids[at + row])), out_v.append(ids[near][best]), out_s.append(scores[best])
    empty = [np.empty(0)]
    return np.concatenate(out_q or empty), np.concatenate(out_v or empty), np.concatenate(out_s or empty)


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector (array of double) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"))
        .filter("id IS NOT NULL AND vector IS NOT NULL").filter(finite & F.exists("vector", lambda x: x != 0))
    )


def _index(rows: DataFrame) -> DataFrame:
    """id, vector, bits, norm, agreement."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, same in batch.groupby(batch["vector"].map(len)):
                bits, norm, agreement = encode(np.stack(same["vector"]), rotation(size))
                yield same.assign(bits=[b.tobytes() for b in bits], norm=norm, agreement=agreement)

    return in_small_batches(rows).mapInPandas(run, "id long, vector array<double>, bits binary, norm double, agreement double")


def nearest(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = NEAREST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of every row whose id is divisible by 20.

    Score is the inner product in double precision; ties go to the smaller id. Rows with a NULL id or vector, a
    zero vector, or a component that is NULL or not finite take no part. Vectors are compared with those of
    the same number of components. Rows that share an id are several candidates, of which a query of that
    id sees none. With fewer than k candidates all are returned. Vectors of any finite size take part; a score
    beyond a double is infinite, and one that is no number is NULL and comes last.
    """
    indexed = saved(_index(usable(table, id_column, vector_column)).withColumn("size", F.size("vector")))
    # The numbers of blocks follow from the bytes of all vectors; a vector's block, from a hash.
    asked = indexed.filter(F.col("id") % QUERY_EVERY == 0)

    def blocks(rows: DataFrame, block_bytes: int) -> int:
        total = rows.agg(F.sum(F.col("size") * 8)).first()[0] or 0
        return max(1, -(-total // block_bytes))

    n_vectors, n_queries = blocks(indexed, VECTOR_BLOCK_BYTES), blocks(asked, QUERY_BLOCK_BYTES)
    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n_vectors)).cast("int")
    vectors = indexed.withColumn("vector_block", block).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    queries = (
        # Aliases, as both sides come from one table and Spark would mix up their columns.
        asked.select(*[F.col(c).alias(c) for c in ("id", "vector", "size")], F.pmod(F.xxhash64("id"), F.lit(n_queries)).cast("int").alias("query_block"))
        .withColumn("vector_block", F.explode(F.sequence(F.lit(0), F.lit(n_vectors - 1))))
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        matrix = np.stack(right["vector"])
        bits = np.frombuffer(b"".join(right["bits"]), dtype=np.uint8).reshape(len(right), -1)
        q, v, s = search_block(
            left["id"].to_numpy(), np.stack(left["vector"]), right["id"].to_numpy(), matrix, bits,
            right["norm"].to_numpy(), right["agreement"].to_numpy(), rotation(matrix.shape[1]), k,
        )
        return pd.DataFrame({"query_id": q.astype(np.int64), "vec_id": v.astype(np.int64), "score": s})

    keys = ["size", "query_block", "vector_block"]
    met = queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
