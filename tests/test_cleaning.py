from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger.operators import cleaning
from skyledger.schemas import FLIGHTS
from tests.support import dicts, raw_table, rows


def clean(spark, **change):
    return dicts(ops.clean_flights(raw_table(spark, change)))


def test_schema(spark):
    cleaned = ops.clean_flights(raw_table(spark, {}))
    assert {f.name: f.dataType for f in cleaned.schema} == {f.name: f.dataType for f in FLIGHTS}


def test_typed_row(spark):
    (row,) = clean(spark, CARRIER_DELAY="7", WEATHER_DELAY="bad")
    assert row["FL_DATE"] == datetime.date(2024, 1, 5)
    assert (row["YEAR"], row["MONTH"]) == (2024, 1)
    assert (row["DEP_DELAY"], row["CARRIER_DELAY"], row["WEATHER_DELAY"]) == (5.0, 7.0, None)
    assert (row["CANCELLED"], row["CANCELLATION_CODE"]) == (0, "N/A")


def test_missing_keys_are_removed(spark):
    for column in ("ORIGIN", "OP_UNIQUE_CARRIER"):
        for value in (None, "", "  "):
            assert clean(spark, **{column: value}) == []
        assert clean(spark, **{column: " X "})[0][column] == " X "


def test_range_bounds(spark):
    for column in ("DEP_DELAY", "ARR_DELAY"):
        for value, kept in (("-120", 1), ("1500", 1), ("-120.01", 0), ("1500.01", 0), ("NaN", 0), (None, 1)):
            assert len(clean(spark, **{column: value})) == kept
            assert len(clean(spark, **{column: value, "CANCELLED": "true"})) == 1


def test_unknown_delay_is_zero_unless_cancelled(spark):
    (operated,) = clean(spark, DEP_DELAY=None, ARR_DELAY="x")
    assert (operated["DEP_DELAY"], operated["ARR_DELAY"]) == (0.0, 0.0)
    (cancelled,) = clean(spark, DEP_DELAY="9", ARR_DELAY=None, CANCELLED="1.00")
    assert (cancelled["DEP_DELAY"], cancelled["ARR_DELAY"]) == (9.0, None)


def test_bad_date_keeps_the_row(spark):
    (row,) = clean(spark, FL_DATE="someday")
    assert (row["FL_DATE"], row["YEAR"], row["MONTH"]) == (None, None, None)


def test_headers_are_normalised_and_other_columns_dropped(spark):
    table = raw_table(spark, {})
    odd = table.toDF(*[f" {c.lower()} " for c in table.columns]).withColumn("Extra", F.lit(1))
    assert rows(ops.clean_flights(odd)) == rows(ops.clean_flights(table))


def test_missing_columns_are_reported_and_skipped(spark):
    table = raw_table(spark, {}).drop("NAS_DELAY", "CANCELLATION_CODE", "DEST")
    assert cleaning.missing_columns(table) == ["DEST", "CANCELLATION_CODE", "NAS_DELAY"]
    cleaned = ops.clean_flights(table)
    assert not {"NAS_DELAY", "CANCELLATION_CODE", "DEST"} & set(cleaned.columns)
    assert cleaned.count() == 1


def test_report_counts_each_stage(spark):
    table = raw_table(spark, {}, {"ORIGIN": " "}, {"DEP_DELAY": "1501"}, {"DEP_DELAY": "1501", "ORIGIN": None}, {})
    assert dicts(ops.cleaning_report(table)) == [
        {"stage": "raw", "rows_left": 5, "rows_removed": 0},
        {"stage": "key_filter", "rows_left": 3, "rows_removed": 2},
        {"stage": "range_filter", "rows_left": 2, "rows_removed": 1},
    ]


def test_report_agrees_with_the_table(raw, flights):
    report = {r["stage"]: r["rows_left"] for r in dicts(ops.cleaning_report(raw))}
    assert report == {"raw": raw.count(), "key_filter": cleaning.key_filter(cleaning.parse_types(raw)).count(),
                      "range_filter": flights.count()}


def test_every_planted_case_occurs(raw):
    found = raw.agg(
        F.count_if(F.col("FL_DATE") == "not-a-date").alias("dates"),
        F.count_if(F.col("OP_UNIQUE_CARRIER").isNull()).alias("no_carrier"),
        F.count_if(F.col("OP_UNIQUE_CARRIER") == " ").alias("blank_carrier"),
        F.count_if(F.col("ORIGIN") == "").alias("blank_airport"),
        F.count_if(F.col("DEP_DELAY") == "1501.0").alias("late"),
        F.count_if(F.col("CANCELLED") == "true").alias("true"),
        F.count_if(F.col("CANCELLATION_CODE") == " a").alias("codes"),
    ).first()
    assert all(found)
