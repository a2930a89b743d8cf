from __future__ import annotations

import glob
import json
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skyledger import operators as ops
from skyledger import session, sinks, sources
from skyledger.schemas import AIRLINE_STATS, ANOMALY_RANKING, FLIGHTS
from tests.support import dicts, flight_table, raw_table, rows


def part_files(folder):
    return [p for p in glob.glob(f"{folder}/**/part-*", recursive=True)]


# Sources


def test_csv_is_read_as_text(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("fl_date, Origin ,DEP_DELAY\n2024-01-01,JFK,5.0\n2024-01-02,,\n")
    raw = sources.read_raw_csv(spark, str(tmp_path / "raw.csv"))
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert [tuple(r) for r in raw.collect()] == [("2024-01-01", "JFK", "5.0"), ("2024-01-02", None, None)]


def test_csv_falls_back_only_for_a_missing_path(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a\n1\n")
    there, absent = str(tmp_path / "raw.csv"), str(tmp_path / "absent.csv")
    assert sources.read_raw_csv(spark, absent, there).count() == 1
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_raw_csv(spark, absent)
    with pytest.raises(ValueError):
        sources.read_raw_csv(spark)
    with pytest.raises(Exception, match="nofilesystem"):
        sources.read_raw_csv(spark, "nofilesystem://x/y.csv", there)


def test_layout():
    layout = sources.Layout("hdfs://host:9000/")
    assert layout.flights() == layout.flights("full") == "hdfs://host:9000/data/cleaned/stage=kept"
    for wrong in ("050", "pct100", "pct_5", "", "pct_050x"):
        with pytest.raises(ValueError, match="no subset"):
            layout.flights(wrong)
    assert layout.flights("pct_050") == "hdfs://host:9000/data/subsets/pct_050"
    assert layout.output("job31", "pct_050") == "hdfs://host:9000/data/outputs/job31/pct_050"
    assert layout.output("job31") == "hdfs://host:9000/data/outputs/job31/full"
    assert layout.timings == "hdfs://host:9000/data/outputs/timings"


def test_view(spark, flights):
    sources.register_view(flights, "some_flights")
    assert spark.sql("SELECT COUNT(*) FROM some_flights").first()[0] == sources.count_rows(flights)


def test_external_table_sees_only_known_partitions(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    table = flight_table(spark, {}, {"MONTH": 2}, {"MONTH": 3, "YEAR": 2023}, {"MONTH": None, "YEAR": None})
    sinks.write_clustered(table, path)
    sources.create_database(spark, "test_db")
    sources.create_flights_table(spark, "test_db.some", path, ["ORIGIN", "CANCELLED"])
    assert spark.table("test_db.some").columns == ["ORIGIN", "CANCELLED", "YEAR", "MONTH"]
    assert spark.table("test_db.some").count() == 0
    sources.add_months(spark, "test_db.some", path, 2024)
    assert spark.table("test_db.some").count() == 2
    sources.find_partitions(spark, "test_db.some")
    assert spark.table("test_db.some").count() == 4
    sources.create_flights_table(spark, "test_db.some", path)
    sources.find_partitions(spark, "test_db.some")
    assert rows(spark.table("test_db.some")) == rows(table)


def test_scratch_folder(spark):
    first, second = session.scratch_dir(spark), session.scratch_dir(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


# Sinks


def test_clustered_write(spark, flights, tmp_path):
    path = str(tmp_path / "cleaned")
    sinks.write_clustered(flights, path)
    assert os.path.isdir(f"{path}/YEAR=1996/MONTH=1")
    assert rows(sources.read_flights(spark, path)) == rows(flights)


def test_a_hot_month_is_split_over_tasks(spark, tmp_path):
    """A third of all rows in one month."""
    hot = spark.range(60_000).select(F.lit(6).alias("MONTH"), F.md5(F.col("id").cast("string")).alias("n"))
    rest = spark.range(120_000).select((F.col("id") % 12 + 1).cast("int").alias("MONTH"), F.col("id").cast("string").alias("n"))
    typed = {f.name: F.lit(None).cast(f.dataType) for f in FLIGHTS if f.name not in ("YEAR", "MONTH", "ORIGIN")}
    skewed = hot.union(rest).repartition(8).withColumnsRenamed({"n": "ORIGIN"})
    skewed = skewed.withColumns({**typed, "YEAR": F.lit(2024)}).select(*FLIGHTS.names)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "100k")
    try:
        sinks.write_clustered(skewed, str(tmp_path / "cleaned"))
    finally:
        spark.conf.unset(key)
    files = Counter(os.path.basename(os.path.dirname(p)) for p in part_files(tmp_path / "cleaned"))
    assert files["MONTH=6"] > 1
    assert sources.read_flights(spark, str(tmp_path / "cleaned")).count() == 180_000


def test_report_files(spark, flights, tmp_path):
    folder = str(tmp_path / "report")
    stats = ops.airline_stats(flights)
    saved = sinks.write_report(stats, folder, ("airline", "airport"))
    assert rows(saved) == rows(stats)
    (json_file,), (csv_file,) = part_files(f"{folder}/json"), part_files(f"{folder}/csv")
    with open(json_file) as lines:
        assert [json.loads(line) for line in lines] == [
            {k: v for k, v in r.items() if v is not None} for r in dicts(stats)
        ]
    with open(csv_file) as lines:
        assert next(lines).strip() == ",".join(AIRLINE_STATS.names)
    text = ops.airline_stats_text(stats)
    assert rows(spark.read.schema(text.schema).csv(f"{folder}/csv", header=True)) == rows(text)


def test_a_path_may_hold_a_quote(spark, flights, tmp_path):
    place = str(tmp_path / "it's here")
    ranking = ops.anomaly_ranking(flights)
    sources.create_database(spark, "quoted_db", f"{place}/db")
    sinks.create_result_table(spark, "quoted_db.ranking", ANOMALY_RANKING, f"{place}/ranking")
    assert rows(sinks.overwrite_result(ranking, "quoted_db.ranking")) == rows(ranking)


def test_months_are_dealt_out_without_adaptive_execution(spark, flights, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_clustered(flights.repartition(8), str(tmp_path / "cleaned"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = Counter(os.path.dirname(p) for p in part_files(tmp_path / "cleaned"))
    assert max(files.values()) <= 4  # as many as there are shuffle partitions
    assert rows(sources.read_flights(spark, str(tmp_path / "cleaned"))) == rows(flights)


def test_one_file_or_one_per_partition(spark, tmp_path):
    numbers = spark.range(1000).repartition(4)
    sinks.write_csv(numbers, str(tmp_path / "one"), ("id",), files=1)
    (file,) = part_files(tmp_path / "one")
    with open(file) as lines:
        assert lines.read().split() == ["id", *map(str, range(1000))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_csv(numbers, str(tmp_path / "many"), ("id",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(part_files(tmp_path / "many"))
    assert len(files) > 1
    in_order = []
    for file in files:
        with open(file) as lines:
            in_order += lines.read().split()[1:]
    assert in_order == list(map(str, range(1000)))


def test_export_skips_marked_files(spark, flights, tmp_path):
    source = tmp_path / "result"
    ranking = ops.anomaly_ranking(flights)
    ranking.write.parquet(str(source))
    (source / "_note").write_text("not a table")
    sinks.export_csv(spark, str(source), str(tmp_path / "csv"))
    assert rows(spark.read.schema(ANOMALY_RANKING).csv(str(tmp_path / "csv"), header=True)) == rows(ranking)


def test_export_takes_only_the_named_files(spark, flights, tmp_path):
    source = tmp_path / "result"
    ranking = ops.anomaly_ranking(flights)
    ranking.write.parquet(str(source))
    (source / "notes.txt").write_text("not a table, and longer than a file's closing mark")
    with pytest.raises(Exception):
        sinks.export_csv(spark, str(source), str(tmp_path / "fails"))
    sinks.export_csv(spark, str(source), str(tmp_path / "csv"), names="*.parquet")
    assert rows(spark.read.schema(ANOMALY_RANKING).csv(str(tmp_path / "csv"), header=True)) == rows(ranking)


def test_result_table_is_replaced(spark, flights, tmp_path):
    ranking = ops.anomaly_ranking(flights)
    sources.create_database(spark, "test_db")
    sinks.create_result_table(spark, "test_db.ranking", ANOMALY_RANKING, str(tmp_path / "ranking"))
    for _ in range(2):
        assert rows(sinks.overwrite_result(ranking.select(*reversed(ranking.columns)), "test_db.ranking")) == rows(ranking)
    assert rows(spark.read.parquet(str(tmp_path / "ranking"))) == rows(ranking)


def test_preview(flights):
    stats = ops.airline_stats(flights)
    assert dicts(sinks.preview(stats)) == dicts(stats)[:10]
    assert sinks.preview(stats, 3).count() == 3


def test_raw_csv_to_flights(spark, tmp_path):
    table = raw_table(spark, {"OP_UNIQUE_CARRIER": "A", "CANCELLATION_CODE": "b"}, {"ORIGIN": None}, {"DEP_DELAY": None})
    table.write.option("header", True).csv(str(tmp_path / "raw"))
    assert rows(ops.clean_flights(sources.read_raw_csv(spark, str(tmp_path / "raw")))) == rows(ops.clean_flights(table))
