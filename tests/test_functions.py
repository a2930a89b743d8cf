from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger import functions as fn
from skyledger.functions.causes import CAUSES
from tests.support import dicts


def values(spark, kind, items, expression):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in table.orderBy("i").select(expression).collect()]


def test_delay_band_bounds(spark):
    delays = [None, -30.0, 14.99, 15.0, 60.0, 60.01]
    assert values(spark, "double", delays, fn.delay_band("x")) == ["basso", "basso", "basso", "medio", "medio", "alto"]


def test_label_bounds_are_strict(spark):
    diffs = [15.0, 15.01, -15.0, -15.01, None]
    assert values(spark, "double", diffs, fn.anomaly_label(F.col("x"))) == [
        "NELLA_NORMA",
        "ANOMALO_PEGGIORE",
        "NELLA_NORMA",
        "ANOMALO_MIGLIORE",
        "NELLA_NORMA",
    ]
    assert values(spark, "double", [5.5], fn.anomaly_label(F.col("x"), 5.0)) == ["ANOMALO_PEGGIORE"]


@pytest.mark.parametrize(
    ("text", "flag"),
    [("1", 1), ("1.0", 1), ("1.00", 1), ("true", 1), ("True", 1), (" TRUE ", 1), ("0", 0), ("0.0", 0), ("0.00", 0),
     ("false", 0), ("yes", 0), ("2", 0), ("", 0), (None, 0)],
)
def test_flag(spark, text, flag):
    assert values(spark, "string", [text], fn.flag_to_int("x")) == [flag]


def test_code(spark):
    assert values(spark, "string", [None, " a", "B", "c ", ""], fn.clean_code("x")) == ["N/A", "A", "B", "C", ""]


def test_has_text(spark):
    assert values(spark, "string", [None, "", "  ", " x "], fn.has_text("x")) == [False, False, False, True]


def test_parse_date(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-5", "2024", "2024-01-05 10:00", "05/01/2024", "", None]
    found = values(spark, "string", texts, fn.parse_date("x").cast("string"))
    assert found == ["2024-02-29"] + [None] * 7


def test_parse_date_equals_pattern_parse(spark):
    texts = ["1995-03-01", "2024-12-31", "2024-13-01", "2024-00-10", "not-a-date", "0x24-01-01", "2024-01-32"]
    pattern = values(spark, "string", texts, F.try_to_date("x", "yyyy-MM-dd"))
    assert values(spark, "string", texts, fn.parse_date("x")) == pattern


def test_in_range_keeps_bounds_and_null(spark):
    delays = [-120.0, 1500.0, -120.01, 1500.01, None]
    assert values(spark, "double", delays, fn.in_range("x", -120, 1500)) == [True, True, False, False, True]


def test_round_half_up(spark):
    assert values(spark, "double", [37.675, -37.675, 77.625, 1.005, 2.344], fn.round2(F.col("x"))) == [
        37.68,
        -37.68,
        77.63,
        1.01,
        2.34,
    ]


def causes(spark, *totals, k=3):
    table = spark.createDataFrame([totals], ", ".join(f"{c} double" for c in CAUSES))
    top = fn.top_causes(k)
    return dicts(table.select(top.alias("top"), fn.causes_text(top).alias("text")))[0]


def test_causes_largest_first_ties_in_fixed_order(spark):
    found = causes(spark, 1.0, 3.0, 3.0, 0.0, None)
    assert found["text"] == "[('Weather', 3.0), ('NAS', 3.0), ('Carrier', 1.0)]"
    assert found["top"][0] == {"cause": "Weather", "impact": 3.0}


def test_causes_cut_at_k_and_skip_what_is_not_positive(spark):
    assert causes(spark, 5.0, -1.0, 4.0, 6.0, 7.0)["text"] == "[('Late Aircraft', 7.0), ('Security', 6.0), ('Carrier', 5.0)]"
    assert causes(spark, 5.0, 1.0, 4.0, 6.0, 7.0, k=1)["text"] == "[('Late Aircraft', 7.0)]"
    assert len(causes(spark, 5.0, 1.0, 4.0, 6.0, 7.0, k=5)["top"]) == 5


def test_no_causes(spark):
    assert causes(spark, 0.0, None, 0.0, -2.0, None) == {"top": [], "text": "[]"}


def test_not_a_number_takes_no_place(spark):
    nan = float("nan")
    assert causes(spark, nan, 4.0, 3.0, 2.0, 1.0)["text"] == "[('Weather', 4.0), ('NAS', 3.0), ('Security', 2.0)]"
    assert causes(spark, nan, nan, None, nan, nan)["text"] == "[]"


@pytest.mark.parametrize("impact", [1e29, 1e-12, 1 / 3, 0.1 + 0.2, 1.5e300, 12.25, float("inf")])
def test_no_entry_is_lost_or_loses_digits(spark, impact):
    found = causes(spark, impact, 1.0, 2.0, None, None, k=5)
    assert len(found["top"]) == found["text"].count("('") == 3
    number = found["text"].split("('Carrier', ")[1].split(")")[0]
    assert float(number.replace("Infinity", "inf")) == impact


@pytest.mark.parametrize("impact", [3134.0, 12.25, 0.5, 10000000.0, 123456789012.75, 100.0])
def test_cause_numbers_are_written_without_exponent(spark, impact):
    assert causes(spark, impact, None, None, None, None)["text"] == str([("Carrier", impact)])
