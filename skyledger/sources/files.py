"""Reading raw CSV files and the Parquet tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.cleaning import normalise_headers
from skyledger.schemas import FLIGHTS, LOGGED, PARTIALS, PARTITION_COLUMNS, TIMINGS


# So many headers are read at once.
HEADER_READERS = 16
# The folder of rows without a value.
UNKNOWN = "__HIVE_DEFAULT_PARTITION__"
Month = tuple[int | None, int | None]


def read_raw_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of ``paths`` that exists, with its header and every column as text.

    A path may hold many files. Files of one header are read together; tables of unlike headers meet by
    column name, upper-cased and stripped, and a column that some lack is NULL there. A file without a line has no
    rows. Only a missing path leads on to the next one; any other error is raised.
    """
    if not paths:
        raise ValueError("no path given")
    missing = None
    for path in paths:
        try:
            return _read_by_header(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = error
    raise missing


def _read_by_header(spark: SparkSession, path: str) -> DataFrame:
    files = sorted(spark.read.text(path).inputFiles())

    def header(file: str) -> str | None:
        line = spark.read.text(_literal(file)).first()
        return None if line is None else line[0]

    with ThreadPool(HEADER_READERS) as pool:
        headers = pool.map(header, files)
    groups: dict[str, list[str]] = {}
    for file, line in zip(files, headers):
        if line is not None:
            groups.setdefault(line, []).append(_literal(file))
    if len(groups) <= 1:
        return spark.read.csv(path, header=True, inferSchema=False)
    tables = [normalise_headers(spark.read.csv(group, header=True, inferSchema=False)) for group in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _literal(file: str) -> str:
    """A listed file's address as a path to read: without its percent signs, and with no pattern in it."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned flights; YEAR and MONTH come from the folder names, the schema needs no file read."""
    return spark.read.schema(FLIGHTS).parquet(path)


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """The run time log, one entry per run; columns an older entry lacks are NULL.

    Of several entries of a run id, which a retry leaves, the one of the least time counts. Entries without a run
    id are runs of their own.
    """
    entries = spark.read.schema(LOGGED).parquet(path)
    entry = F.struct("elapsed_seconds", *[c for c in TIMINGS.names if c != "elapsed_seconds"])
    once = entries.filter("run_id IS NOT NULL").groupBy("run_id").agg(F.min(entry).alias("entry")).select("entry.*")
    return entries.filter("run_id IS NULL").select(*TIMINGS.names).unionByName(once)


def months_in(spark: SparkSession, path: str) -> dict[Month, set[str]]:
    """The files of each (year, month) folder of a table, from a listing; none if there is no such table."""
    try:
        files = spark.read.schema(FLIGHTS).parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[Month, set[str]] = {}
    for file in files:
        year, month = re.search(r"/YEAR=([^/]+)/MONTH=([^/]+)/[^/]+$", file).groups()
        found.setdefault((_number(year), _number(month)), set()).add(file)
    return found


def _number(text: str) -> int | None:
    return None if text in (UNKNOWN, "null") else int(text)


def month_folder(month: Month) -> str:
    """The folder of a (year, month) below its table's."""
    return "/".join(f"{c}={UNKNOWN if v is None else v}" for c, v in zip(PARTITION_COLUMNS, month))


def in_months(months: Iterable[Month]) -> Column:
    """The row lies in one of these (year, month) folders."""
    here = [F.col("YEAR").eqNullSafe(F.lit(y).cast("int")) & F.col("MONTH").eqNullSafe(F.lit(m).cast("int")) for y, m in months]
    return reduce(lambda a, b: a | b, here, F.lit(False))


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The stored partial aggregates."""
    return spark.read.schema(PARTIALS).parquet(path)


def count_rows(table: DataFrame) -> int:
    """Number of rows; over Parquet files this reads no column."""
    return table.count()


def register_view(table: DataFrame, name: str) -> DataFrame:
    """The table under a name for SQL text in the same session."""
    table.createOrReplaceTempView(name)
    return table
