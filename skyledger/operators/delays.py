"""Delay bands and leading causes per airport and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import causes_text, delay_band, round2, top_causes
from skyledger.functions.causes import CAUSES

# Cancellation code and minutes column that feed each total. No code stands for late aircraft.
CAUSE_SOURCES = {
    "carrier_val": ("A", "CARRIER_DELAY"),
    "weather_val": ("B", "WEATHER_DELAY"),
    "nas_val": ("C", "NAS_DELAY"),
    "security_val": ("D", "SECURITY_DELAY"),
    "late_aircraft_val": (None, "LATE_AIRCRAFT_DELAY"),
}


def _airport_month() -> list[Column]:
    return [F.col("ORIGIN").alias("airport"), F.coalesce("MONTH", F.lit(0)).alias("month")]


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _band_averages() -> list[Column]:
    return [
        F.count("*").alias("flight_count"),
        round2(F.avg(or_zero("DEP_DELAY"))).alias("avg_dep_delay"),
        round2(F.avg(or_zero("ARR_DELAY"))).alias("avg_arr_delay"),
    ]


def cause_sums() -> list[Column]:
    """Minutes of each cause plus one for every flight cancelled for it."""
    sums = []
    for total, (code, minutes) in CAUSE_SOURCES.items():
        value = or_zero(minutes)
        if code is not None:
            for_code = (F.col("CANCELLED") == 1) & (F.col("CANCELLATION_CODE") == code)
            value = value + F.when(for_code, 1.0).otherwise(0.0)
        sums.append(F.sum(value).alias(total))
    return sums


def delay_band_stats(flights: DataFrame) -> DataFrame:
    """Flights and average delays per (airport, month, band).

    An unknown delay counts as 0 and an unknown month as month 0.
    """
    return flights.groupBy(*_airport_month(), delay_band("DEP_DELAY").alias("delay_band")).agg(*_band_averages())


def cause_totals(flights: DataFrame) -> DataFrame:
    """One total per cause for each (airport, month)."""
    return flights.groupBy(*_airport_month()).agg(*cause_sums())


def top_cause_rows(totals: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` leading causes of each row of :func:`cause_totals`, one row per cause, with its place."""
    placed = totals.select("airport", "month", F.posexplode(top_causes(k)).alias("at", "entry"))
    return placed.select("airport", "month", (F.col("at") + 1).alias("place"), "entry.cause", "entry.impact")


def with_causes_text(rows: DataFrame, k: int) -> DataFrame:
    """The report's columns and order, from averages beside cause totals."""
    return rows.select(
        "airport",
        "month",
        "avg_arr_delay",
        "avg_dep_delay",
        "delay_band",
        "flight_count",
        causes_text(top_causes(k)).alias(f"top{k}_causes"),
    ).orderBy("airport", "month", "delay_band")


def join_causes(bands: DataFrame, totals: DataFrame, k: int = 3) -> DataFrame:
    """:func:`delay_band_stats` beside :func:`cause_totals`, for tables that were computed apart."""
    return with_causes_text(bands.join(totals, ["airport", "month"], "left"), k)


def delay_report(flights: DataFrame, k: int = 3) -> DataFrame:
    """Bands of each (airport, month) beside its ``k`` leading causes.

    :func:`join_causes` would read the flights twice. Here they are aggregated once, per band, with the
    causes in the same pass; a month's causes are the sum over its bands, of which there are at most three.
    As in the join, where NULL equals nothing, flights without an airport have bands but no causes.
    """
    whole_month = Window.partitionBy("airport", "month")
    bands = flights.groupBy(*_airport_month(), delay_band("DEP_DELAY").alias("delay_band")).agg(
        *_band_averages(), *cause_sums()
    )
    known = F.col("airport").isNotNull()
    sums = {total: F.when(known, F.sum(total).over(whole_month)) for total in CAUSES}
    return with_causes_text(bands.withColumns(sums), k)
