"""Writing flights tables, reports and the run time log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.schemas import LOGGED, PARTITION_COLUMNS

# Over so many tasks a month is dealt out where adaptive execution cannot split it by its size.
MONTH_SPLITS = 16


def write_partitioned(flights: DataFrame, path: str, columns: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Parquet in YEAR / MONTH folders, without a shuffle. For input that already lies by month."""
    flights.write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_clustered(flights: DataFrame, path: str, columns: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Parquet in YEAR / MONTH folders, with few files per month.

    A plain repartition by month would give each month, however large, to one task. The rebalance hint
    lets adaptive execution split a large month over tasks and join small ones, by measured bytes. Without
    adaptive execution Spark ignores the hint, so months are dealt out by a hash of their rows.
    """
    write_partitioned(_dealt(flights, columns), path, columns)


def _dealt(flights: DataFrame, columns: Sequence[str]) -> DataFrame:
    if flights.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return flights.hint("rebalance", *columns)
    plain = [f.name for f in flights.schema if not isinstance(f.dataType, T.MapType)]
    return flights.repartition(*columns, F.pmod(F.xxhash64(*plain), F.lit(MONTH_SPLITS)))


def replace_months(flights: DataFrame, path: str, columns: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Replace just those folders that the table has rows for; all others keep their files.

    New files are written beside the old ones and take their place when all tasks are done, so a job that fails
    changes nothing. To replace a folder by no rows, see :func:`empty_folder`.
    """
    clustered = _dealt(flights, columns)
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def empty_folder(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """No rows in one folder of a table; ``schema`` without the columns that the folder's path names."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def preview(table: DataFrame, n: int = 10) -> DataFrame:
    """The first rows; after a sort Spark keeps only ``n`` rows per task instead of sorting all."""
    return table.limit(n)


def arrays_as_text(table: DataFrame) -> DataFrame:
    """Array columns as text, joined by ``", "``, for formats without arrays."""
    arrays = [f.name for f in table.schema if isinstance(f.dataType, T.ArrayType)]
    return table.withColumns({c: F.concat_ws(", ", F.col(c).cast("array<string>")) for c in arrays})


def _in_files(table: DataFrame, order: Sequence[str], files: int | None) -> DataFrame:
    """The table in at most ``files`` sorted partitions; with None sorted as a whole, one file per partition."""
    if files is None:
        return table.orderBy(*order) if order else table
    few = table.coalesce(files)
    return few.sortWithinPartitions(*order) if order else few


def write_json(table: DataFrame, path: str, order: Sequence[str] = (), files: int | None = None) -> None:
    """JSON lines."""
    _in_files(table, order, files).write.mode("overwrite").json(path)


def write_csv(table: DataFrame, path: str, order: Sequence[str] = (), files: int | None = None) -> None:
    """CSV with header, arrays as text."""
    arrays_as_text(_in_files(table, order, files)).write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str, order: Sequence[str] = (), files: int | None = 1) -> DataFrame:
    """Run the query once, into ``path/parquet``; make ``path/json`` and ``path/csv`` from that.

    A report has a row per airport and airline, or month and band, so one file holds it; ``files=None`` writes
    as many as there are partitions. Returns the saved table. A saved table outlives the loss of executors,
    where a cached one would make Spark read the flights again.
    """
    report.write.mode("overwrite").parquet(f"{path}/parquet")
    saved = report.sparkSession.read.schema(report.schema).parquet(f"{path}/parquet")
    write_json(saved, f"{path}/json", order, files)
    write_csv(saved, f"{path}/csv", order, files)
    return saved


def append_timing(
    spark: SparkSession,
    path: str,
    job: str,
    subset: str,
    elapsed_seconds: float,
    record_count: int,
    technology: str = "spark_sql",
    environment: str | None = None,
    run_id: str | None = None,
) -> None:
    """One more row in the run time log.

    A run that is tried again under the same ``run_id`` counts once when the log is read; without one
    each call is a run.
    """
    row = (job, technology, subset, environment, float(elapsed_seconds), int(record_count), run_id or uuid.uuid4().hex)
    spark.createDataFrame([row], LOGGED).write.mode("append").parquet(path)


def export_csv(
    spark: SparkSession,
    source: str,
    target: str,
    order: Sequence[str] = (),
    names: str | None = None,
    files: int | None = None,
) -> DataFrame:
    """All Parquet files of a result folder as CSV; returns the table that was exported.

    Names that start with ``_`` or ``.`` are left out. If other files lie there too, ``names`` is the
    pattern of the wanted ones, such as ``*.parquet``. A damaged Parquet file is an error, not skipped.
    """
    reader = spark.read if names is None else spark.read.option("pathGlobFilter", names)
    table = reader.parquet(source)
    write_csv(table, target, order, files)
    return table
