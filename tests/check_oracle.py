"""Compare every query with its SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    """Rows as a multiset, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty if the query and its SQL agree, else what differs."""
    result = queries()[name](spark, sf_dir)
    found = rows_of(result.columns, [tuple(r) for r in result.collect()])
    if name not in oracle_sql():
        return "" if found else "no rows"
    answer = con.execute(oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    expected = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    if found != expected:
        return f"only in Spark {list((found - expected).items())[:3]}, only in SQL {list((expected - found).items())[:3]}"
    return "" if found else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    counts = Counter()
    for name in names:
        started = time.monotonic()
        problem = compare(spark, con, sf_dir, name)
        verdict = "differs" if problem else "equal" if name in oracle_sql() else "has rows, no SQL"
        counts[verdict] += 1
        print(f"{name:28} {time.monotonic() - started:6.2f}s {verdict} {problem}".rstrip(), flush=True)
    print(", ".join(f"{n} {verdict}" for verdict, n in counts.items()))
    return counts["differs"]


if __name__ == "__main__":
    sys.exit(main())
