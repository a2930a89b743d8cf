"""Partial aggregates of the flights, stored by month, from which every report is merged.

A row has what the reports need of one airline's flights at one airport in one month and delay band: sums, counts,
bounds and a month mask, all of which merge by adding, comparing or or-ing. A report over a year so reads a
few rows per month and pair instead of the flights, and one more month costs one more month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import delay_band, has_text, percent, round2
from skyledger.functions.causes import CAUSES
from skyledger.operators.airlines import stats_columns
from skyledger.operators.anomalies import operated, rank_and_label
from skyledger.operators.delays import cause_sums, or_zero, with_causes_text
from skyledger.schemas import PARTITION_COLUMNS

KEYS = ["airport", "airline", "delay_band"]


def flight_partials(flights: DataFrame) -> DataFrame:
    """One row per month, airport, airline and delay band, NULL keys included; see :data:`skyledger.schemas.PARTIALS`."""
    return flights.groupBy(
        F.col("ORIGIN").alias("airport"), F.col("OP_UNIQUE_CARRIER").alias("airline"), delay_band("DEP_DELAY").alias("delay_band"), *PARTITION_COLUMNS
    ).agg(
        F.count("*").alias("flights"),
        F.sum("CANCELLED").alias("cancelled"),
        F.sum("ARR_DELAY").alias("arr_sum"),
        F.count("ARR_DELAY").alias("arr_count"),
        F.min("ARR_DELAY").alias("arr_min"),
        F.max("ARR_DELAY").alias("arr_max"),
        F.sum(or_zero("DEP_DELAY")).alias("dep_zero_sum"),
        F.sum(or_zero("ARR_DELAY")).alias("arr_zero_sum"),
        F.sum(operated("DEP_DELAY")).alias("dep_operated_sum"),
        F.count(operated("DEP_DELAY")).alias("dep_operated_count"),
        F.sum(operated("ARR_DELAY")).alias("arr_operated_sum"),
        F.count(operated("ARR_DELAY")).alias("arr_operated_count"),
        *cause_sums(),
        F.expr("COALESCE(bit_or(shiftleft(1, MONTH)), 0)").alias("months"),
    )


def _mean(total: str, count: str) -> Column:
    return round2(F.try_divide(F.sum(total), F.sum(count)))


def airline_stats_from(partials: DataFrame) -> DataFrame:
    """:func:`skyledger.operators.airline_stats` of the flights behind the partials."""
    stats = partials.groupBy("airline", "airport").agg(
        F.sum("flights").alias("total_flights"),
        F.min("arr_min").alias("min_arr_delay"),
        F.max("arr_max").alias("max_arr_delay"),
        _mean("arr_sum", "arr_count").alias("avg_arr_delay"),
        percent(F.sum("cancelled"), F.sum("flights")).alias("cancellation_rate_pct"),
        F.expr("bit_or(months)").alias("months"),
    )
    return stats_columns(stats)


def delay_report_from(partials: DataFrame, k: int = 3) -> DataFrame:
    """:func:`skyledger.operators.delay_report` of the flights behind the partials."""
    bands = partials.groupBy("airport", F.coalesce("MONTH", F.lit(0)).alias("month"), "delay_band").agg(
        F.sum("flights").alias("flight_count"),
        _mean("dep_zero_sum", "flights").alias("avg_dep_delay"),
        _mean("arr_zero_sum", "flights").alias("avg_arr_delay"),
        *[F.sum(total).alias(total) for total in CAUSES],
    )
    whole_month = Window.partitionBy("airport", "month")
    known = F.col("airport").isNotNull()
    sums = {total: F.when(known, F.sum(total).over(whole_month)) for total in CAUSES}
    return with_causes_text(bands.withColumns(sums), k)


def anomaly_ranking_from(partials: DataFrame, threshold: float = 15.0) -> DataFrame:
    """:func:`skyledger.operators.anomaly_ranking` of the flights behind the partials."""
    whole_airport = Window.partitionBy("airport")
    sums = partials.filter(has_text("airport")).groupBy("airport", "airline").agg(
        F.sum("flights").alias("flight_count"),
        F.sum("dep_operated_sum").alias("dep_sum"),
        F.sum("dep_operated_count").alias("dep_count"),
        _mean("arr_operated_sum", "arr_operated_count").alias("avg_arr_delay"),
        percent(F.sum("cancelled"), F.sum("flights")).alias("cancellation_rate_pct"),
    )
    pairs = sums.select(
        "airport",
        "airline",
        "flight_count",
        round2(F.try_divide("dep_sum", "dep_count")).alias("avg_dep_delay"),
        "avg_arr_delay",
        "cancellation_rate_pct",
        round2(F.try_divide(F.sum("dep_sum").over(whole_airport), F.sum("dep_count").over(whole_airport))).alias("airport_avg_dep_delay"),
        F.sum("flight_count").over(whole_airport).alias("airport_total_flights"),
    )
    return rank_and_label(pairs.filter(has_text("airline")), threshold)
