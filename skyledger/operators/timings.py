"""Run times: overview tables of the log that the jobs append to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def consolidate_timings(timings: DataFrame) -> DataFrame:
    """The log in reading order."""
    return timings.orderBy("job", "subset", "technology", "environment", "elapsed_seconds")


def _mean_seconds(timings: DataFrame) -> DataFrame:
    """One mean per (job, technology, subset, environment), as a log may hold repeated runs."""
    return timings.groupBy("environment", "job", "technology", "subset").agg(
        F.avg("elapsed_seconds").alias("seconds")
    )


def timing_pivot(timings: DataFrame) -> DataFrame:
    """Mean seconds per (environment, job, technology), one column per subset that the log names."""
    subsets = [r.subset for r in timings.select("subset").distinct().orderBy("subset").collect()]
    wide = timings.groupBy("environment", "job", "technology").pivot("subset", subsets)
    return wide.agg(F.round(F.avg("elapsed_seconds"), 1)).orderBy("environment", "job", "technology")


def timing_totals(timings: DataFrame) -> DataFrame:
    """Seconds of all jobs together per (environment, technology, subset)."""
    return (
        _mean_seconds(timings)
        .groupBy("environment", "technology", "subset")
        .agg(F.round(F.sum("seconds"), 1).alias("total_seconds"))
        .orderBy("environment", "technology", "subset")
    )


def speedup(timings: DataFrame, base: str = "local", other: str = "aws") -> DataFrame:
    """How many times faster each (job, technology, subset) ran in ``other`` than in ``base``.

    Only what ran in both is listed, with a NULL speedup where ``other`` took no time. The two sides meet in
    one aggregate, without a join.
    """
    both = (
        timings.groupBy("job", "technology", "subset")
        .pivot("environment", [base, other])
        .agg(F.avg("elapsed_seconds"))
    )
    ran_in_both = both.filter(F.col(base).isNotNull() & F.col(other).isNotNull())
    return ran_in_both.select(
        "job",
        "technology",
        "subset",
        F.round(base, 1).alias("base_seconds"),
        F.round(other, 1).alias("other_seconds"),
        F.round(F.try_divide(base, other), 2).alias("speedup"),
    ).orderBy("job", "technology", "subset")
