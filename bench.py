"""Benchmark: prints one JSON line.

Two scales. The plain names run on the flights derived from ``$BENCH_SF_DIR``, best of three runs. The
names in ``_copies`` run once on ``$BENCH_COPIES`` variants of them, which differ in date, flight number and
arrival delay: twelve of sf0.1 are 7.1 million flights, the size of the published timings. The CSV has 35
columns, as the published one, of which cleaning wants 14. A job does what the published ones do: read, count, run the
query, write JSON and CSV (and here Parquet), log the run time.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyledger import fixtures, sinks  # noqa: E402
from skyledger import operators as ops  # noqa: E402
from skyledger.plans import REPORTS, run_cleaning, run_report  # noqa: E402
from skyledger.sources import Layout, read_flights  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "12"))
RUNS = 3


def timed(action: Callable[[], object], runs: int = 1) -> float:
    best = float("inf")
    for _ in range(runs):
        started = time.monotonic()
        action()
        best = min(best, time.monotonic() - started)
    return round(best, 3)


def discard(table) -> None:
    table.write.format("noop").mode("overwrite").save()


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        spark = (
            SparkSession.builder.master(f"local[{CPUS}]")
            .appName("bench")
            .config("spark.driver.memory", "16g")
            .config("spark.sql.shuffle.partitions", CPUS)
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.checkpoint.dir", f"{folder}/shared")
            .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
        seconds: dict[str, float] = {}

        def raw_csv(copies: int, path: str) -> None:
            variant = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("variant")
            raw = fixtures.raw_flights(spark, SF_DIR).select("*", variant)
            varied = {
                "FL_DATE": F.coalesce(F.date_add(F.try_to_date("FL_DATE"), F.col("variant")).cast("string"), "FL_DATE"),
                "OP_CARRIER_FL_NUM": F.concat("OP_CARRIER_FL_NUM", "variant"),
                "ARR_DELAY": (F.col("ARR_DELAY").cast("double") + F.col("variant")).cast("string"),
            }
            unwanted = {f"OTHER_{k}": F.concat_ws("-", F.lit(k), "OP_CARRIER_FL_NUM") for k in range(21)}
            wide = raw.withColumns(varied).withColumns(unwanted).drop("variant")
            wide.repartition(int(CPUS)).write.option("header", True).csv(path)

        small, large = Layout(f"{folder}/small"), Layout(f"{folder}/large")
        raw_csv(1, small.raw)
        seconds["cleaning"] = timed(lambda: run_cleaning(spark, small).collect(), RUNS)

        flights = read_flights(spark, small.cleaned)
        rows = flights.count()
        for name, report in REPORTS.items():
            seconds[f"{name}_query"] = timed(lambda: discard(report.query(flights)), RUNS)
        for name in REPORTS:
            seconds[name] = timed(lambda: run_report(spark, small, name), RUNS)
        seconds["subset_200"] = timed(
            lambda: sinks.write_partitioned(ops.make_subset(flights, 200), small.flights("pct_200")), RUNS
        )

        raw_csv(COPIES, large.raw)
        seconds["cleaning_copies"] = timed(lambda: run_cleaning(spark, large).collect())
        for name in REPORTS:
            seconds[f"{name}_copies"] = timed(lambda: run_report(spark, large, name))

        print(
            json.dumps(
                {
                    "metric": "total seconds of all queries",
                    "value": round(sum(seconds.values()), 3),
                    "unit": "sec",
                    "queries": seconds,
                    "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                    "rows": rows,
                    "rows_copies": read_flights(spark, large.cleaned).count(),
                    "cpus": int(CPUS),
                }
            ),
            flush=True,
        )
        spark.stop()


if __name__ == "__main__":
    main()
