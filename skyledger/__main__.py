"""Command line: ``python -m skyledger <command> --base <folder>``, or ``spark-submit submit.py ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from skyledger.operators import label_distribution, worst_pairs
from skyledger.plans import (
    REPORTS,
    run_cleaning,
    run_cleaning_month,
    run_partials,
    run_quarantine,
    run_report,
    run_report_merged,
    run_report_table,
    run_subsets,
    run_timings,
)
from skyledger.session import session
from skyledger.sinks import export_csv
from skyledger.sources import Layout


def _month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    if not 1 <= int(month) <= 12:
        raise ValueError(f"no month: {text}")
    return int(year), int(month)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skyledger")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--base", required=True, help="folder of all tables, e.g. hdfs://host:9000")
        return sub

    clean = command("clean", "raw CSV to the cleaned table")
    clean.add_argument("--raw", nargs="*", default=[], help="CSV paths to try in turn")
    clean.add_argument("--month", default=None, type=_month, help="replace only this month, e.g. 2024-03")
    command("quarantine", "what cleaning took out, by reason and raw text")
    partials = command("partials", "partial aggregates of months that lack them")
    partials.add_argument("--month", nargs="*", default=None, type=_month, help="of these months, e.g. 2024-03")
    subsets = command("subsets", "scaled copies of the cleaned table")
    subsets.add_argument("--percent", nargs="*", type=int, default=[25, 50, 100, 200])
    for name in REPORTS:
        report = command(name, "write this report")
        report.add_argument("--subset", default=None, help="pct_025 and the like; the full table if left out")
        report.add_argument("--environment", default=None, help="name of this cluster in the run time log")
        report.add_argument("--database", default=None, help="run on catalog tables of this database instead")
        report.add_argument("--merged", action="store_true", help="merge the full table's report from partial aggregates")
        report.add_argument("--run-id", default=None, help="a run that is tried again under the same id is logged once")
    command("timings", "run time log as one CSV")
    export = commands.add_parser("export", help="a folder of Parquet files as CSV")
    export.add_argument("source")
    export.add_argument("target")
    export.add_argument("--names", default=None, help="pattern of the wanted file names, e.g. *.parquet")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = session(f"skyledger-{args.command}")
    if args.command == "export":
        export_csv(spark, args.source, args.target, names=args.names)
        return
    layout = Layout(args.base)
    if args.command == "clean":
        if args.month:
            run_cleaning_month(spark, layout, *args.month, *args.raw).show()
        else:
            run_cleaning(spark, layout, *args.raw).show()
    elif args.command == "quarantine":
        run_quarantine(spark, layout).orderBy(F.desc("rows"), "reason").show(50, truncate=False)
    elif args.command == "partials":
        for year, month in run_partials(spark, layout, args.month):
            print(year, month)
    elif args.command == "subsets":
        run_subsets(spark, layout, args.percent)
    elif args.command == "timings":
        run_timings(spark, layout).show(50)
    else:
        if args.merged:
            if args.subset or args.database:
                raise SystemExit("--merged is for the full table")
            result = run_report_merged(spark, layout, args.command, args.environment, args.run_id)
        elif args.database:
            result = run_report_table(spark, layout, args.command, args.database, args.subset, args.environment, args.run_id)
        else:
            result = run_report(spark, layout, args.command, args.subset, args.environment, args.run_id)
        result.show(10, truncate=False)
        if args.command == "anomaly_ranking":
            label_distribution(result).show()
            worst_pairs(result).show(truncate=False)


if __name__ == "__main__":
    main()
