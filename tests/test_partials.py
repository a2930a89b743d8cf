from __future__ import annotations

import pytest

from skyledger import operators as ops
from skyledger import sinks
from skyledger.plans import REPORTS, run_partials, run_report_merged
from skyledger.plans.jobs import MERGED
from skyledger.schemas import PARTIALS
from skyledger.sources import Layout, month_folder, months_in, read_partials, read_timings
from tests.support import dicts, flight_table, rows


@pytest.fixture(scope="module")
def partials(flights, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("partials"))
    sinks.replace_months(ops.flight_partials(flights), path)
    return read_partials(flights.sparkSession, path)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_partials_are_those_from_flights(flights, partials, name):
    assert rows(MERGED[name](partials)) == rows(REPORTS[name].query(flights))


def test_partials_have_their_schema(flights):
    found = ops.flight_partials(flights)
    assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in PARTIALS}


def test_odd_flights_merge_to_the_same_reports(spark):
    odd = flight_table(
        spark,
        {"ORIGIN": None}, {"OP_UNIQUE_CARRIER": None}, {"ORIGIN": " "}, {"YEAR": None, "MONTH": None, "DEP_DELAY": None},
        {"CANCELLED": 1, "DEP_DELAY": None, "ARR_DELAY": 7.0, "CANCELLATION_CODE": "A"}, {"CANCELLED": 1, "ARR_DELAY": None, "CANCELLATION_CODE": "B", "ORIGIN": "LAX"},
        {"DEP_DELAY": 70.0, "NAS_DELAY": float("nan")}, {"MONTH": 12, "YEAR": 2023, "SECURITY_DELAY": 2.5},
    )
    for name, merge in MERGED.items():
        assert rows(merge(ops.flight_partials(odd))) == rows(REPORTS[name].query(odd))
        assert merge(ops.flight_partials(odd.filter("false"))).collect() == []


def test_one_more_month_reads_only_that_month(spark, flights, tmp_path):
    layout = Layout(str(tmp_path))
    sinks.write_clustered(flights, layout.cleaned)
    months = sorted(months_in(spark, layout.cleaned), key=str)
    later = months[1]
    run_partials(spark, layout, [m for m in months if m != later])
    stored = months_in(spark, layout.partials)
    assert later not in stored and len(stored) == len(months) - 1

    saved = run_report_merged(spark, layout, "airline_stats", "here", "run 1")
    assert rows(saved) == rows(ops.airline_stats(flights))
    after = months_in(spark, layout.partials)
    assert {m: f for m, f in after.items() if m != later} == stored and later in after
    assert run_partials(spark, layout) == []

    # The merge reads partials, and the flights' scan is pruned to the month's folder.
    plan = read_partials(spark, layout.partials)._jdf.queryExecution().executedPlan().toString()
    assert "data/partials" in plan and "data/cleaned" not in plan
    (entry,) = dicts(read_timings(spark, layout.timings))
    assert (entry["technology"], entry["record_count"]) == ("spark_merged", flights.count())


def test_a_month_without_flights_loses_its_partials(spark, tmp_path):
    layout = Layout(str(tmp_path))
    sinks.write_clustered(flight_table(spark, {}, {"MONTH": 2}), layout.cleaned)
    run_partials(spark, layout)
    sinks.empty_folder(spark, flight_table(spark, {}).drop("YEAR", "MONTH").schema, f"{layout.cleaned}/{month_folder((2024, 2))}")
    run_partials(spark, layout, [(2024, 2)])
    assert [r.MONTH for r in read_partials(spark, layout.partials).collect()] == [1]
