"""Catalog tables over existing flights files."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from skyledger.schemas import FLIGHTS, PARTITION_COLUMNS
from skyledger.sources.files import UNKNOWN, month_folder, months_in


def quoted(path: str) -> str:
    """A path as SQL text."""
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Unless it exists; its own folder is in the warehouse if no location is given."""
    place = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_flights_table(
    spark: SparkSession, name: str, location: str, columns: Iterable[str] | None = None
) -> None:
    """(Re)declare an external table over a flights folder, with all columns or those a job needs.

    Dropping it leaves the files. Its partitions stay invisible until :func:`find_partitions` or
    :func:`add_months` names them.
    """
    wanted = [f.name for f in FLIGHTS] if columns is None else list(columns)
    data = [c for c in wanted if c not in PARTITION_COLUMNS]
    declared = ", ".join(f"{c} {FLIGHTS[c].dataType.simpleString()}" for c in data + PARTITION_COLUMNS)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({declared}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION {quoted(location)}"
    )


def find_partitions(spark: SparkSession, name: str) -> None:
    """Make every partition folder of the table visible."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def sync_partitions(spark: SparkSession, name: str, location: str) -> tuple[int, int]:
    """Partition folders that the table lacks are added to it and those without files are taken out; how many of both.

    A listing of the folders and the catalog's list are compared, so a run that finds nothing new changes nothing, where
    a repair looks at every folder again.
    """
    found = {month_folder(m): m for m in months_in(spark, location)}
    known = {r.partition.replace("=null", f"={UNKNOWN}") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added, gone = sorted(found.keys() - known), sorted(known - found.keys())
    if added:
        places = " ".join(f"PARTITION ({_spec(folder)}) LOCATION {quoted(f'{location}/{folder}')}" for folder in added)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(f'PARTITION ({_spec(folder)})' for folder in gone)}")
    return len(added), len(gone)


def _spec(folder: str) -> str:
    """A partition's folder as SQL."""
    return folder.replace("/", ", ").replace(UNKNOWN, "NULL")


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files are, without scheme and host; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return urlsplit(rows[0].data_type).path.rstrip("/")


def add_months(
    spark: SparkSession, name: str, location: str, year: int, months: Iterable[int] = range(1, 13)
) -> None:
    """Make just these months visible, whether they hold files or not."""
    parts = " ".join(
        f"PARTITION (YEAR={year}, MONTH={m}) LOCATION {quoted(f'{location}/YEAR={year}/MONTH={m}')}" for m in months
    )
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
