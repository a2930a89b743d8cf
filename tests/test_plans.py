"""What Spark makes of the queries: scans, shuffles, and what reaches the files."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from skyledger import operators as ops
from skyledger import sinks
from skyledger.operators import cleaning
from tests.support import flight_table, rows


def plan(table):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        table.explain("formatted")
    return out.getvalue()


def tree(text):
    """The operators alone, without the details that follow."""
    return re.sub(r"\(\d+\)\s*$", "", text.split("\n\n")[0], flags=re.M)


def nodes(text, name):
    """How often a physical operator occurs."""
    return len(re.findall(rf"^\(\d+\) {name}", text, re.M))


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", text).group(1)))


REPORTS = {
    "airline_stats": (ops.airline_stats, {"OP_UNIQUE_CARRIER", "ORIGIN", "ARR_DELAY", "CANCELLED"}, 2),
    "delay_report": (
        ops.delay_report,
        {"ORIGIN", "DEP_DELAY", "ARR_DELAY", "CANCELLED", "CANCELLATION_CODE", "CARRIER_DELAY", "WEATHER_DELAY",
         "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"},
        3,
    ),
    "anomaly_ranking": (ops.anomaly_ranking, {"OP_UNIQUE_CARRIER", "ORIGIN", "DEP_DELAY", "ARR_DELAY", "CANCELLED"}, 3),
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_scan_once_and_shuffle_aggregates_only(flights, name):
    query, columns, shuffles = REPORTS[name]
    text = plan(query(flights))
    assert nodes(text, "Scan parquet") == 1
    assert read_columns(text) == columns
    assert nodes(text, "Exchange") == shuffles
    assert nodes(text, "(BroadcastExchange|BroadcastHashJoin|SortMergeJoin|CartesianProduct)") == 0
    # Below the last exchange of the tree, which is the first to run, there is only a hash aggregate over the scan.
    first = [line.strip(" +-:*()0123456789") for line in tree(text).split("Exchange")[-1].splitlines()[1:]]
    assert first[0] == "HashAggregate" and set(first) <= {"HashAggregate", "Project", "Filter", "ColumnarToRow", "Scan parquet"}
    assert "Python" not in text and "ObjectHashAggregate" not in tree(text)


def test_cleaning_is_one_narrow_pass(raw):
    text = plan(ops.clean_flights(raw))
    assert nodes(text, "Exchange") == 0
    assert nodes(text, "Scan parquet") == 1
    assert "IsNotNull(ORIGIN)" in text


def test_report_of_cleaning_scans_once_and_reads_only_what_it_needs(raw):
    text = plan(ops.cleaning_report(raw))
    assert nodes(text, "Scan parquet") == 1
    assert read_columns(text) == {"ORIGIN", "OP_UNIQUE_CARRIER", "CANCELLED", "DEP_DELAY", "ARR_DELAY"}


def test_key_filter_reaches_the_files(flights):
    assert "PushedFilters: [IsNotNull(ORIGIN)" in plan(ops.anomaly_ranking(flights))


def test_months_are_pruned(flights):
    text = plan(ops.delay_report(flights.filter("YEAR = 1996 AND MONTH IN (1, 2)")))
    assert re.search(r"PartitionFilters: \[.*YEAR.*MONTH", text)


def test_top_lists_keep_few_rows(flights):
    for table in (ops.worst_pairs(ops.anomaly_ranking(flights)), sinks.preview(ops.airline_stats(flights))):
        assert nodes(plan(table), "TakeOrderedAndProject") == 1


def test_copies_are_one_scan(flights):
    assert nodes(plan(ops.make_subset(flights, 200)), "Scan parquet") == 1


def test_speedup_needs_no_join(flights, spark, sf_dir):
    from skyledger import fixtures

    text = plan(ops.speedup(fixtures.timings(spark, sf_dir)))
    assert nodes(text, "Scan parquet") == 1 and "Join" not in text


def test_join_forms_need_one_shuffle_per_side_and_key(flights):
    text = tree(plan(ops.join_causes(ops.delay_band_stats(flights), ops.cause_totals(flights))))
    assert text.count("Scan parquet") == 2 and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_months_are_rebalanced_before_they_are_written(flights):
    dealt = tree(plan(flights.hint("rebalance", "YEAR", "MONTH")))
    assert dealt.count("Exchange") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(flights.hint("rebalance", "YEAR", "MONTH"))


def test_cleaning_by_stage_parses_each_number_once(raw):
    text = plan(cleaning.cleaning_stages(raw))
    assert nodes(text, "Scan parquet") == 1 and nodes(text, "Exchange") == 0 and nodes(text, "Filter") == 0
    assert len(re.findall("try_cast\\(DEP_DELAY", text)) == 1


def test_single_stages_do_not_shuffle(raw):
    for step in (cleaning.parse_types, cleaning.add_date_parts, cleaning.normalise_codes):
        assert nodes(plan(step(raw)), "Exchange") == 0


@pytest.fixture(scope="module")
def skewed_pairs(spark, tmp_path_factory):
    """Written pairs of which nearly all belong to one airport, and the baselines of many airports."""
    folder = tmp_path_factory.mktemp("skewed")
    flights = flight_table(spark, *[{"OP_UNIQUE_CARRIER": f"A{n}", "DEP_DELAY": float(n % 90)} for n in range(3000)], *[{"ORIGIN": f"X{n}"} for n in range(300)])
    tables = []
    for name, table in (("pairs", ops.pair_stats(flights)), ("airports", ops.airport_baseline(flights))):
        table.write.parquet(f"{folder}/{name}")
        tables.append(spark.read.schema(table.schema).parquet(f"{folder}/{name}"))
    return flights, *tables


@pytest.mark.parametrize("bound, joined, other", [("10m", "BroadcastHashJoin", "SortMergeJoin"), ("1k", "SortMergeJoin", "BroadcastHashJoin"), ("-1", "SortMergeJoin", "BroadcastHashJoin")])
def test_baselines_are_broadcast_below_the_bound_only(spark, skewed_pairs, bound, joined, other):
    """The side's size is looked at, by its files before and by its bytes at run time; no hint overrules it."""
    flights, pairs, airports = skewed_pairs
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, bound)
    try:
        result = ops.join_baseline(pairs, airports)
        found = rows(result)
        final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for name in names:
            spark.conf.unset(name)
    assert joined in final and other not in final
    assert found == rows(ops.anomaly_ranking(flights))


def test_a_skewed_airport_is_split_where_the_join_is_large(spark, skewed_pairs):
    """Above the bound, adaptive execution deals the rows of one airport over several tasks."""
    _, pairs, airports = skewed_pairs
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "16k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = pairs.repartition(8).join(airports, "airport")
        assert joined.groupBy().count().first()[0] == pairs.count()
        joined.write.format("noop").mode("overwrite").save()
        collected = joined.select("airport", "airline", "airport_avg_dep_delay")
        collected.collect()
        final = collected._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in final
