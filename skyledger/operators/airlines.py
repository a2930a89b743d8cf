"""Statistics per airline and airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import percent, round2


def airline_stats(flights: DataFrame) -> DataFrame:
    """Flights, arrival delay, cancellation rate and months flown per (airline, airport).

    NULL delays are skipped, a cancelled flight with a known delay counts. One aggregate does it all: the
    months are gathered as bits of one number, a buffer of fixed width like the sums beside it, which stays in
    the generated hash aggregate, where a set per group would not.
    """
    stats = flights.groupBy(F.col("OP_UNIQUE_CARRIER").alias("airline"), F.col("ORIGIN").alias("airport")).agg(
        F.count("*").alias("total_flights"),
        F.min("ARR_DELAY").alias("min_arr_delay"),
        F.max("ARR_DELAY").alias("max_arr_delay"),
        round2(F.try_divide(F.sum("ARR_DELAY"), F.count("ARR_DELAY"))).alias("avg_arr_delay"),
        percent(F.sum("CANCELLED"), F.count("*")).alias("cancellation_rate_pct"),
        F.expr("COALESCE(bit_or(shiftleft(1, MONTH)), 0)").alias("months"),
    )
    return stats_columns(stats)


def stats_columns(stats: DataFrame) -> DataFrame:
    """The report's columns and order, from statistics with the months as bits."""
    months = F.array(*[F.lit(m) for m in range(1, 13)])
    flown = F.filter(months, lambda m: F.getbit("months", m) == 1).alias("active_months")
    return stats.select(*[c for c in stats.columns if c != "months"], flown).orderBy("airline", "airport")


def airline_stats_text(stats: DataFrame) -> DataFrame:
    """The statistics with the months as text, ``1, 2, 3``, for formats without arrays."""
    return stats.withColumn("active_months", F.concat_ws(", ", "active_months"))
