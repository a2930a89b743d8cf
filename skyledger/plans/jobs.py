"""The jobs end to end: read, compute, write, log the run time."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators import (
    airline_stats,
    airline_stats_from,
    anomaly_ranking,
    anomaly_ranking_from,
    consolidate_timings,
    delay_report,
    delay_report_from,
    flight_partials,
    make_subset,
)
from skyledger.operators.cleaning import REASONS, cleaning_stages, missing_columns, quarantine_report, stage_report
from skyledger.operators.subsets import subset_label
from skyledger.schemas import PARTIALS, PARTITION_COLUMNS, STAGES
from skyledger.sinks import (
    append_timing,
    create_result_table,
    empty_folder,
    overwrite_result,
    replace_months,
    write_clustered,
    write_csv,
    write_partitioned,
    write_report,
)
from skyledger.sources import (
    Layout,
    count_rows,
    create_database,
    create_flights_table,
    in_months,
    month_folder,
    months_in,
    read_flights,
    read_partials,
    read_raw_csv,
    read_timings,
    sync_partitions,
    table_location,
)
from skyledger.sources.files import Month
from skyledger.sources.layout import subset_name

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Report:
    """A report: its name in folders and in the run time log, its query and its row order."""

    job: str
    query: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...]


REPORTS = {
    "airline_stats": Report("job31", airline_stats, ("airline", "airport")),
    "delay_report": Report("job32", delay_report, ("airport", "month", "delay_band")),
    "anomaly_ranking": Report("job33", anomaly_ranking, ("airport", "rank_in_airport", "airline")),
}
# The same reports from stored partial aggregates.
MERGED = {"airline_stats": airline_stats_from, "delay_report": delay_report_from, "anomaly_ranking": anomaly_ranking_from}


def run_cleaning(spark: SparkSession, layout: Layout, *raw_paths: str) -> DataFrame:
    """Raw CSV to the cleaned table; returns rows left and removed per stage.

    The CSV is read once. Rows that a stage takes out are written too, with the reason and their raw text, in a
    folder of that stage; so the counts come from what was written, and stay right when Spark repeats a lost task.
    """
    raw = read_raw_csv(spark, *(raw_paths or (layout.raw,)))
    if missing := missing_columns(raw):
        log.warning("columns not found and left out: %s", ", ".join(missing))
    write_clustered(cleaning_stages(raw), layout.stages, ["stage", *PARTITION_COLUMNS])
    return stage_report(spark.read.schema(STAGES).parquet(layout.stages))


def run_cleaning_month(spark: SparkSession, layout: Layout, year: int, month: int, *raw_paths: str) -> DataFrame:
    """Raw CSV of one month in place of what is cleaned of it; returns rows left and removed per stage.

    Only this month's folders change. Rows of another month, or of none, are set aside under this month, as the
    CSV does not say whose they are. Running it again gives the same table.
    """
    raw = read_raw_csv(spark, *(raw_paths or (layout.raw,)))
    if missing := missing_columns(raw):
        log.warning("columns not found and left out: %s", ", ".join(missing))
    folders = [f"{layout.stages}/stage={stage}" for stage in ("kept", *dict.fromkeys(REASONS.values()))]
    with _replacing(spark, folders, [(year, month)], STAGES):
        replace_months(cleaning_stages(raw, month=(year, month)), layout.stages, ["stage", *PARTITION_COLUMNS])
    if months_in(spark, layout.partials):
        run_partials(spark, layout, [(year, month)])
    stages = spark.read.schema(STAGES).parquet(layout.stages)
    return stage_report(stages.filter(in_months([(year, month)])))


@contextmanager
def _replacing(spark: SparkSession, folders: Iterable[str], months: Iterable[Month], schema: T.StructType) -> Iterator[None]:
    """Inside, the months are written anew below each folder; where there was nothing to write, old files go."""
    before = {folder: months_in(spark, folder) for folder in folders}
    yield
    columns = T.StructType([f for f in schema if f.name not in ("stage", *PARTITION_COLUMNS)])
    for folder, files in before.items():
        after = months_in(spark, folder)
        for month in months:
            if after.get(month, set()) & files.get(month, set()):
                empty_folder(spark, columns, f"{folder}/{month_folder(month)}")


def run_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """The rows that cleaning took out, by reason and raw text."""
    return quarantine_report(spark.read.schema(STAGES).parquet(layout.stages))


def run_partials(spark: SparkSession, layout: Layout, months: Iterable[Month] | None = None) -> list[Month]:
    """Partial aggregates of these months, or of those that have flights but no partials; returns the months.

    Only the flights of these months are read.
    """
    stored = months_in(spark, layout.partials)
    wanted = [m for m in months_in(spark, layout.cleaned) if m not in stored] if months is None else list(months)
    if wanted:
        flights = read_flights(spark, layout.cleaned).filter(in_months(wanted))
        with _replacing(spark, [layout.partials], wanted, PARTIALS):
            replace_months(flight_partials(flights), layout.partials)
    return sorted(wanted, key=str)


def run_report_merged(spark: SparkSession, layout: Layout, name: str, environment: str | None = None, run_id: str | None = None) -> DataFrame:
    """One report on the full table, merged from partials; months that lack them get them first.

    The run time log has it under technology ``spark_merged``.
    """
    report, query = REPORTS[name], MERGED[name]
    started = time.monotonic()
    run_partials(spark, layout)
    partials = read_partials(spark, layout.partials)
    saved = write_report(query(partials), f"{layout.output(report.job)}_merged", report.order)
    records = partials.agg(F.sum("flights")).first()[0] or 0
    seconds = time.monotonic() - started
    append_timing(
        spark, layout.timings, report.job, subset_name(None), seconds, records, technology="spark_merged", environment=environment, run_id=run_id
    )
    return saved.orderBy(*report.order)


def run_subsets(spark: SparkSession, layout: Layout, percents: Iterable[int] = (25, 50, 100, 200)) -> None:
    """Scaled copies of the cleaned table."""
    flights = read_flights(spark, layout.cleaned)
    for percent in percents:
        write_partitioned(make_subset(flights, percent), layout.flights(subset_label(percent)))


def run_report(
    spark: SparkSession,
    layout: Layout,
    name: str,
    subset: str | None = None,
    environment: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One report on the full table or a subset, as Parquet, JSON and CSV; returns the saved result."""
    report = REPORTS[name]
    started = time.monotonic()
    flights = read_flights(spark, layout.flights(subset))
    saved = write_report(report.query(flights), layout.output(report.job, subset), report.order)
    records = count_rows(flights)
    append_timing(
        spark,
        layout.timings,
        report.job,
        subset_name(subset),
        time.monotonic() - started,
        records,
        environment=environment,
        run_id=run_id,
    )
    return saved.orderBy(*report.order)


def run_report_table(
    spark: SparkSession,
    layout: Layout,
    name: str,
    database: str,
    subset: str | None = None,
    environment: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One report from a catalog table over the flights' files into a result table; returns that table.

    Each report declares a table of its own, so that two reports at once do not disturb each other. The run
    time log has it under technology ``spark_table``.
    """
    report, label = REPORTS[name], subset_name(subset)
    started = time.monotonic()
    source, target = f"{database}.flights_{label}_{name}", f"{database}.{name}_{label}"
    create_database(spark, database)
    place = layout.flights(subset)
    if table_location(spark, source) != urlsplit(place).path:
        create_flights_table(spark, source, place)
    sync_partitions(spark, source, place)
    spark.catalog.refreshTable(source)
    result = report.query(spark.table(source))
    create_result_table(spark, target, result.schema, f"{layout.output(report.job, subset)}/table")
    saved = overwrite_result(result, target)
    records = count_rows(spark.table(source))
    seconds = time.monotonic() - started
    append_timing(
        spark, layout.timings, report.job, label, seconds, records, technology="spark_table", environment=environment, run_id=run_id
    )
    return saved.orderBy(*report.order)


def run_timings(spark: SparkSession, layout: Layout) -> DataFrame:
    """The whole run time log as one sorted CSV."""
    entries = read_timings(spark, layout.timings)
    order = ("job", "subset", "technology", "environment", "elapsed_seconds")
    write_csv(entries, layout.timings_report, order, files=1)
    return consolidate_timings(entries)
