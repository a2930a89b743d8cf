"""Airlines ranked inside each airport, with unusually late and punctual ones marked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import anomaly_label, has_text, percent, round2
from skyledger.functions.flights import LABEL_WORSE


def operated(name: str) -> Column:
    return F.when(F.col("CANCELLED") == 0, F.col(name))


def pair_stats(flights: DataFrame) -> DataFrame:
    """Flights, average delays of operated flights and cancellation rate per (airport, airline)."""
    return (
        flights.filter(has_text("ORIGIN") & has_text("OP_UNIQUE_CARRIER"))
        .groupBy(F.col("ORIGIN").alias("airport"), F.col("OP_UNIQUE_CARRIER").alias("airline"))
        .agg(
            F.count("*").alias("flight_count"),
            round2(F.avg(operated("DEP_DELAY"))).alias("avg_dep_delay"),
            round2(F.avg(operated("ARR_DELAY"))).alias("avg_arr_delay"),
            percent(F.sum("CANCELLED"), F.count("*")).alias("cancellation_rate_pct"),
        )
    )


def airport_baseline(flights: DataFrame) -> DataFrame:
    """Average departure delay and number of flights per airport, flights without an airline included."""
    return (
        flights.filter(has_text("ORIGIN"))
        .groupBy(F.col("ORIGIN").alias("airport"))
        .agg(
            round2(F.avg(operated("DEP_DELAY"))).alias("airport_avg_dep_delay"),
            F.count("*").alias("airport_total_flights"),
        )
    )


def rank_in_airport() -> Column:
    """Place of an airline inside its airport, punctual first; ties share a place, NULL comes last."""
    by_delay = Window.partitionBy("airport").orderBy(F.asc_nulls_last("avg_dep_delay"))
    return F.rank().over(by_delay)


def rank_and_label(pairs: DataFrame, threshold: float) -> DataFrame:
    """The ranking's columns and order, from averages of pairs beside those of their airports.

    Rank and label see a NULL average, the output shows it as 0.
    """
    diff = round2(F.col("avg_dep_delay") - F.col("airport_avg_dep_delay"))
    ranked = pairs.withColumns({"dep_delay_diff": diff, "rank_in_airport": rank_in_airport()})

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)).alias(name)

    return ranked.select(
        "airport",
        "airline",
        "flight_count",
        shown("avg_dep_delay"),
        shown("avg_arr_delay"),
        "cancellation_rate_pct",
        shown("airport_avg_dep_delay"),
        "airport_total_flights",
        shown("dep_delay_diff"),
        "rank_in_airport",
        anomaly_label(F.col("dep_delay_diff"), threshold).alias("anomaly_label"),
    ).orderBy("airport", "rank_in_airport", "airline")


def join_baseline(pairs: DataFrame, airports: DataFrame, threshold: float = 15.0) -> DataFrame:
    """:func:`pair_stats` ranked against :func:`airport_baseline`, for tables that were computed apart."""
    return rank_and_label(pairs.join(airports, "airport"), threshold)


def anomaly_ranking(flights: DataFrame, threshold: float = 15.0) -> DataFrame:
    """Every (airport, airline) against its airport's average.

    :func:`join_baseline` would read the flights twice. Here they are aggregated once, to sums and counts
    per pair; the airport's average comes from the same sums. Both windows run over one row per airline
    of an airport, never over flights, and share one shuffle.
    """
    whole_airport = Window.partitionBy("airport")
    sums = (
        flights.filter(has_text("ORIGIN"))
        .groupBy(F.col("ORIGIN").alias("airport"), F.col("OP_UNIQUE_CARRIER").alias("airline"))
        .agg(
            F.count("*").alias("flight_count"),
            F.sum(operated("DEP_DELAY")).alias("dep_sum"),
            F.count(operated("DEP_DELAY")).alias("dep_count"),
            F.avg(operated("ARR_DELAY")).alias("arr_avg"),
            F.sum("CANCELLED").alias("cancelled"),
        )
    )
    with_airport = sums.withColumns(
        {
            "airport_dep_sum": F.sum("dep_sum").over(whole_airport),
            "airport_dep_count": F.sum("dep_count").over(whole_airport),
            "airport_total_flights": F.sum("flight_count").over(whole_airport),
        }
    )
    pairs = with_airport.filter(has_text("airline")).select(
        "airport",
        "airline",
        "flight_count",
        round2(F.try_divide("dep_sum", "dep_count")).alias("avg_dep_delay"),
        round2(F.col("arr_avg")).alias("avg_arr_delay"),
        percent(F.col("cancelled"), F.col("flight_count")).alias("cancellation_rate_pct"),
        round2(F.try_divide("airport_dep_sum", "airport_dep_count")).alias("airport_avg_dep_delay"),
        "airport_total_flights",
    )
    return rank_and_label(pairs, threshold)


def label_distribution(ranking: DataFrame) -> DataFrame:
    """Pairs per label, most frequent first."""
    counted = ranking.groupBy("anomaly_label").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "anomaly_label")


def worst_pairs(ranking: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` pairs that are furthest above their airport's average."""
    return (
        ranking.filter(F.col("anomaly_label") == LABEL_WORSE)
        .orderBy(F.desc("dep_delay_diff"), "airport", "airline")
        .select("airline", "airport", "avg_dep_delay", "dep_delay_diff", "rank_in_airport")
        .limit(n)
    )
