"""Result tables in the catalog, with their files at a given place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyledger.sources.catalog import quoted


def create_result_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    """(Re)declare an external Parquet table; dropping it leaves the files."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {quoted(location)}")


def overwrite_result(result: DataFrame, name: str) -> DataFrame:
    """Replace the table's rows with ``result`` and return the table."""
    result.select(*result.sparkSession.table(name).columns).write.mode("overwrite").insertInto(name)
    return result.sparkSession.table(name)
