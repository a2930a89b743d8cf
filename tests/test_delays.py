from __future__ import annotations

from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger.functions import causes_text, top_causes
from skyledger.operators import make_subset
from skyledger.schemas import DELAY_REPORT
from tests.support import dicts, flight_table, group, half_up, mean, rows

LABELS = ["Carrier", "Weather", "NAS", "Security", "Late Aircraft"]
MINUTES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]


def band(delay):
    if delay is None or delay < 15:
        return "basso"
    return "medio" if delay <= 60 else "alto"


def leading(members):
    impact = dict.fromkeys(LABELS, 0.0)
    for r in members:
        for label, minutes in zip(LABELS, MINUTES):
            impact[label] += r[minutes] or 0.0
        by_code = dict(zip("ABCD", LABELS)).get(r["CANCELLATION_CODE"])
        if r["CANCELLED"] == 1 and by_code:
            impact[by_code] += 1.0
    return str(sorted([(c, v) for c, v in impact.items() if v > 0], key=lambda e: -e[1])[:3])


def brute_force(records):
    result = []
    for (airport, month), members in group(records, lambda r: (r["ORIGIN"], r["MONTH"] or 0)).items():
        for name, part in group(members, lambda r: band(r["DEP_DELAY"])).items():
            result.append(
                {
                    "airport": airport,
                    "month": month,
                    "avg_arr_delay": half_up(mean([r["ARR_DELAY"] or 0.0 for r in part])),
                    "avg_dep_delay": half_up(mean([r["DEP_DELAY"] or 0.0 for r in part])),
                    "delay_band": name,
                    "flight_count": len(part),
                    "top3_causes": leading(members),
                }
            )
    return sorted(result, key=lambda r: (r["airport"], r["month"], r["delay_band"]))


def test_schema(flights):
    assert [(f.name, f.dataType) for f in ops.delay_report(flights).schema] == [(f.name, f.dataType) for f in DELAY_REPORT]


def test_against_brute_force(flights):
    assert dicts(ops.delay_report(flights)) == brute_force(dicts(flights))


def test_one_scan_equals_join(flights):
    joined = ops.join_causes(ops.delay_band_stats(flights), ops.cause_totals(flights))
    assert dicts(ops.delay_report(flights)) == dicts(joined)


def test_cancelled_flight_counts_as_zero_and_low(spark):
    table = flight_table(spark, {"DEP_DELAY": None, "ARR_DELAY": None, "CANCELLED": 1}, {"DEP_DELAY": 10.0, "ARR_DELAY": 4.0})
    (row,) = dicts(ops.delay_report(table))
    assert (row["delay_band"], row["flight_count"]) == ("basso", 2)
    assert (row["avg_dep_delay"], row["avg_arr_delay"]) == (5.0, 2.0)


def test_unknown_month_is_zero(spark):
    (row,) = dicts(ops.delay_report(flight_table(spark, {"MONTH": None})))
    assert (row["month"], row["top3_causes"]) == (0, "[]")


def test_codes_add_one_each_and_unknown_codes_none(spark):
    codes = ["A", "B", "B", "D", "N/A", "E"]
    table = flight_table(
        spark, *[{"CANCELLED": 1, "CANCELLATION_CODE": c} for c in codes], {"CANCELLATION_CODE": "A"}, {"NAS_DELAY": 1.5}
    )
    (row,) = dicts(ops.cause_totals(table))
    assert row == {"airport": "JFK", "month": 1, "carrier_val": 1.0, "weather_val": 2.0, "nas_val": 1.5,
                   "security_val": 1.0, "late_aircraft_val": 0.0}
    assert dicts(ops.delay_report(table))[0]["top3_causes"] == "[('Weather', 2.0), ('NAS', 1.5), ('Carrier', 1.0)]"


def test_cause_rows_are_the_text_in_rows(flights):
    totals = ops.cause_totals(flights)
    by_month = group(dicts(ops.top_cause_rows(totals)), lambda r: (r["airport"], r["month"]))
    texts = dicts(totals.select("airport", "month", causes_text(top_causes()).alias("text")))
    for r in texts:
        entries = sorted(by_month.get((r["airport"], r["month"]), []), key=lambda e: e["place"])
        assert [e["place"] for e in entries] == list(range(1, len(entries) + 1))
        assert str([(e["cause"], e["impact"]) for e in entries]) == r["text"]


def test_band_counts_add_up(flights):
    total = ops.delay_band_stats(flights).agg(F.sum("flight_count")).first()[0]
    assert total == flights.count()


def test_doubling_keeps_averages(flights):
    def kept(table):
        return rows(ops.delay_report(table).drop("flight_count", "top3_causes"))

    assert kept(flights) == kept(make_subset(flights, 200))
