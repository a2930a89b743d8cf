from __future__ import annotations

import pytest

from skyledger import operators as ops
from skyledger import sinks, sources
from skyledger.schemas import TIMINGS
from skyledger.sinks import append_timing
from skyledger.sources import read_timings
from tests.support import dicts

# Published seconds of three jobs on the full table.
SECONDS = {
    ("job31", "spark_sql"): (48.0, 34.623497009277344),
    ("job31", "spark_core"): (48.8, 58.316938400268555),
    ("job32", "spark_sql"): (68.0, 34.01444983482361),
    ("job32", "spark_core"): (89.3, 83.72410297393799),
    ("job33", "spark_sql"): (56.9, 33.1693377494812),
    ("job33", "spark_core"): (73.8, 79.68071913719177),
}


@pytest.fixture(scope="module")
def log(spark):
    entries = []
    for (job, technology), (local, aws) in SECONDS.items():
        entries.append((job, technology, "pct_100", "local", local, 7078634))
        entries.append((job, technology, "pct_100", "aws", aws, 7078634))
    entries.append(("job31", "spark_sql", "pct_025", "local", 45.1, 1771698))
    return spark.createDataFrame(entries, TIMINGS)


def test_speedup(log):
    found = {(r["job"], r["technology"]): r["speedup"] for r in dicts(ops.speedup(log))}
    assert found == {
        ("job31", "spark_sql"): 1.39,
        ("job31", "spark_core"): 0.84,
        ("job32", "spark_sql"): 2.0,
        ("job32", "spark_core"): 1.07,
        ("job33", "spark_sql"): 1.72,
        ("job33", "spark_core"): 0.93,
    }


def test_totals(log):
    found = {(r["environment"], r["technology"], r["subset"]): r["total_seconds"] for r in dicts(ops.timing_totals(log))}
    assert found[("local", "spark_sql", "pct_100")] == 172.9
    assert found[("local", "spark_core", "pct_100")] == 211.9
    assert found[("aws", "spark_sql", "pct_100")] == 101.8
    assert found[("aws", "spark_core", "pct_100")] == 221.7


def test_repeated_runs_count_once_in_totals(log):
    assert dicts(ops.timing_totals(log.union(log))) == dicts(ops.timing_totals(log))


def test_pivot(log):
    found = {(r["environment"], r["job"], r["technology"]): r for r in dicts(ops.timing_pivot(log))}
    row = found[("local", "job31", "spark_sql")]
    assert (row["pct_025"], row["pct_100"]) == (45.1, 48.0)
    assert found[("aws", "job32", "spark_sql")]["pct_100"] == 34.0


def test_every_logged_subset_has_its_column(spark):
    runs = [("job31", "spark_sql", s, "local", 2.0, 1) for s in ("full", "pct_010", "pct_300")]
    (row,) = dicts(ops.timing_pivot(spark.createDataFrame(runs, TIMINGS)))
    assert {k: v for k, v in row.items() if k not in ("environment", "job", "technology")} == {"full": 2.0, "pct_010": 2.0, "pct_300": 2.0}


def test_speedup_lists_runs_without_a_measured_second(spark):
    runs = [("job31", "spark_sql", "full", "local", 2.0, 1), ("job31", "spark_sql", "full", "aws", 0.0, 1), ("job32", "spark_sql", "full", "aws", 1.0, 1)]
    (row,) = dicts(ops.speedup(spark.createDataFrame(runs, TIMINGS)))
    assert (row["job"], row["base_seconds"], row["other_seconds"], row["speedup"]) == ("job31", 2.0, 0.0, None)


def test_log_is_appended_to_and_consolidated(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.append_timing(spark, path, "job32", "pct_050", 2.5, 20)
    sinks.append_timing(spark, path, "job31", "pct_100", 1.5, 10, technology="hive", environment="local")
    sinks.append_timing(spark, path, "job31", "pct_050", 3.5, 20)
    found = dicts(ops.consolidate_timings(sources.read_timings(spark, path)))
    assert [(r["job"], r["subset"], r["elapsed_seconds"]) for r in found] == [
        ("job31", "pct_050", 3.5),
        ("job31", "pct_100", 1.5),
        ("job32", "pct_050", 2.5),
    ]
    assert (found[1]["technology"], found[1]["environment"], found[0]["environment"]) == ("hive", "local", None)


def test_entries_without_environment_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("job31", "hive", "pct_025", 1.0, 5)], "job string, technology string, subset string, "
                          "elapsed_seconds double, record_count bigint").write.parquet(path)  # fmt: skip
    assert dicts(sources.read_timings(spark, path))[0]["environment"] is None


def test_a_retried_run_counts_once(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.createDataFrame([("job31", "hive", "full", None, 9.0, 5)] * 2, TIMINGS).write.parquet(log)
    for seconds in (12.0, 10.0):
        append_timing(spark, log, "job31", "full", seconds, 100, run_id="nightly 1")
    append_timing(spark, log, "job31", "full", 11.0, 100, run_id="nightly 2")
    for _ in range(2):
        append_timing(spark, log, "job31", "full", 30.0, 100)
    found = sorted((r.technology, r.elapsed_seconds) for r in read_timings(spark, log).collect())
    assert found == [("hive", 9.0), ("hive", 9.0), ("spark_sql", 10.0), ("spark_sql", 11.0), ("spark_sql", 30.0), ("spark_sql", 30.0)]
    assert read_timings(spark, log).schema == TIMINGS
