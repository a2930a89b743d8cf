from __future__ import annotations

import glob

import pytest

from skyledger import fixtures, sinks
from skyledger import operators as ops
from skyledger.__main__ import main
from skyledger.plans import REPORTS
from skyledger.sources import Layout, read_flights, read_timings
from tests.support import dicts, raw_table, rows


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("base")
    fixtures.raw_flights(spark, sf_dir).write.option("header", True).csv(f"{folder}/raw.csv")
    return str(folder)


def test_command_line_from_csv_to_timings(spark, base, flights, capsys):
    layout = Layout(base)
    main(["clean", "--base", base, "--raw", f"{base}/absent.csv", f"{base}/raw.csv"])
    assert rows(read_flights(spark, layout.cleaned)) == rows(flights)
    assert "range_filter" in capsys.readouterr().out

    main(["subsets", "--base", base, "--percent", "50", "200"])
    assert read_flights(spark, layout.flights("pct_200")).count() == 2 * flights.count()

    for name, report in REPORTS.items():
        main([name, "--base", base])
        main([name, "--base", base, "--subset", "pct_200", "--environment", "here"])
        saved = spark.read.parquet(f"{layout.output(report.job)}/parquet")
        assert rows(saved) == rows(report.query(flights))
        for kind in ("json", "csv"):
            assert len(glob.glob(f"{layout.output(report.job, 'pct_200')}/{kind}/part-*")) == 1
    assert "ANOMALO_PEGGIORE" in capsys.readouterr().out

    log = dicts(ops.consolidate_timings(read_timings(spark, layout.timings)))
    assert [(r["job"], r["subset"]) for r in log] == [(j, s) for j in ("job31", "job32", "job33") for s in ("full", "pct_200")]
    assert {r["record_count"] for r in log} == {flights.count(), 2 * flights.count()}
    assert {r["environment"] for r in log} == {None, "here"}

    main(["timings", "--base", base])
    (file,) = glob.glob(f"{layout.timings_report}/part-*")
    with open(file) as lines:
        assert len(lines.readlines()) == 1 + len(log)


def test_reports_on_catalog_tables(spark, base, flights):
    layout = Layout(base)
    sinks.write_clustered(flights, layout.flights("pct_100"))
    for name, report in REPORTS.items():
        main([name, "--base", base, "--subset", "pct_100", "--database", "job_db", "--environment", "there"])
        table = spark.table(f"job_db.{name}_pct_100")
        assert rows(table) == rows(report.query(flights))
        assert table.count() == spark.read.parquet(f"{layout.output(report.job, 'pct_100')}/table").count()
    logged = [r for r in dicts(read_timings(spark, layout.timings)) if r["technology"] == "spark_table"]
    assert sorted((r["job"], r["subset"], r["environment"], r["record_count"]) for r in logged) == [
        (report.job, "pct_100", "there", flights.count()) for report in REPORTS.values()
    ]


def test_a_wrong_subset_is_an_error(base):
    with pytest.raises(ValueError, match="no subset"):
        main(["airline_stats", "--base", base, "--subset", "050"])


def test_missing_columns_are_named(spark, tmp_path, caplog):
    raw_table(spark, {}).drop("DEST", "NAS_DELAY").write.option("header", True).csv(str(tmp_path / "raw"))
    main(["clean", "--base", str(tmp_path), "--raw", str(tmp_path / "raw")])
    assert "columns not found and left out: DEST, NAS_DELAY" in caplog.text


def test_export(spark, flights, tmp_path):
    stats = ops.airline_stats(flights)
    stats.write.parquet(str(tmp_path / "stats"))
    main(["export", str(tmp_path / "stats"), str(tmp_path / "csv"), "--names", "*.parquet"])
    text = ops.airline_stats_text(stats)
    assert rows(spark.read.schema(text.schema).csv(str(tmp_path / "csv"), header=True)) == rows(text)


def test_unknown_command():
    with pytest.raises(SystemExit):
        main(["dance", "--base", "x"])
