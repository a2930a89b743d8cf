"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import saved


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (u, v): root is the smallest node that it reaches.

    Alternating star steps: all larger neighbours of a node move to its smallest neighbour, then all
    smaller ones do. The rounds grow with the logarithm of the longest path. Each step is an aggregate and
    a join on the node, so a node with very many edges is split like any skewed join key; each round is
    written, so that neither lineage nor the loss of an executor makes it start again.
    """
    edges = saved(_larger_first(edges))
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.filter("u <> v"))
        smallest = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(smallest, F.col("u") == F.col("w")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = saved(_larger_first(small.unionByName(smallest.select(F.col("w").alias("u"), F.col("m").alias("v")))))
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
