"""Small hand-made tables and plain Python answers to compare with."""

from __future__ import annotations

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, SparkSession

from skyledger.schemas import FLIGHTS, RAW_FLIGHTS

RAW_ROW = {
    "FL_DATE": "2024-01-05",
    "OP_UNIQUE_CARRIER": "AA",
    "OP_CARRIER_FL_NUM": "1",
    "ORIGIN": "JFK",
    "DEST": "LAX",
    "DEP_DELAY": "5.0",
    "ARR_DELAY": "3.0",
    "CANCELLED": "0.0",
    "CANCELLATION_CODE": None,
    "CARRIER_DELAY": None,
    "WEATHER_DELAY": None,
    "NAS_DELAY": None,
    "SECURITY_DELAY": None,
    "LATE_AIRCRAFT_DELAY": None,
}

FLIGHT_ROW = {
    **RAW_ROW,
    "FL_DATE": None,
    "DEP_DELAY": 5.0,
    "ARR_DELAY": 3.0,
    "CANCELLED": 0,
    "CANCELLATION_CODE": "N/A",
    "YEAR": 2024,
    "MONTH": 1,
}


def raw_table(spark: SparkSession, *changes: dict) -> DataFrame:
    return spark.createDataFrame([{**RAW_ROW, **c} for c in changes], RAW_FLIGHTS)


def flight_table(spark: SparkSession, *changes: dict) -> DataFrame:
    return spark.createDataFrame([{**FLIGHT_ROW, **c} for c in changes], FLIGHTS)


def rows(table: DataFrame) -> Counter:
    """Rows as a multiset, columns by name."""
    names = sorted(table.columns)
    return Counter(tuple(repr(r[n]) for n in names) for r in table.collect())


def dicts(table: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in table.collect()]


def half_up(value: float | None) -> float | None:
    """Two decimals, half up on the printed number."""
    if value is None:
        return None
    return float(Decimal(repr(value)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def mean(values: list[float]) -> float | None:
    return sum(values) / len(values) if values else None


def group(records: list[dict], key) -> dict:
    groups = defaultdict(list)
    for r in records:
        groups[key(r)].append(r)
    return groups


def blank(text: str | None) -> bool:
    return text is None or text.strip(" ") == ""
