"""From raw text rows to the typed, filtered flights table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clean_code, flag_to_int, has_text, in_range, parse_date
from skyledger.schemas import CAUSE_COLUMNS, DELAY_COLUMNS, PARTITION_COLUMNS, RAW_COLUMNS

# Minutes a delay of an operated flight may have, bounds included.
MIN_DELAY, MAX_DELAY = -120, 1500


def normalise_headers(raw: DataFrame) -> DataFrame:
    """Column names upper-cased and stripped."""
    return raw.toDF(*[c.upper().strip() for c in raw.columns])


def missing_columns(raw: DataFrame) -> list[str]:
    """Wanted columns that the raw table lacks."""
    present = set(normalise_headers(raw).columns)
    return [c for c in RAW_COLUMNS if c not in present]


def select_wanted(raw: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The wanted columns that exist, in table order, under normalised names, and ``more`` of the table's columns."""
    names = [c.upper().strip() for c in raw.columns]
    at = {c: names.index(c) for c in RAW_COLUMNS if c in names}
    return raw.select(*[raw[k].alias(c) for c, k in at.items()], *more)


def parse_types(raw: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Delays and causes as double, with NULL for bad text, and the cancellation flag as 0 or 1; ``more`` as it is."""
    rows = select_wanted(raw, more)
    numbers = [c for c in DELAY_COLUMNS + CAUSE_COLUMNS if c in rows.columns]
    parsed = {c: F.col(c).try_cast("double") for c in numbers}
    if "CANCELLED" in rows.columns:
        parsed["CANCELLED"] = flag_to_int("CANCELLED")
    return rows.withColumns(parsed)


def has_keys() -> Column:
    """The flight names its airport and its airline."""
    return has_text("ORIGIN") & has_text("OP_UNIQUE_CARRIER")


def is_plausible(low: float = MIN_DELAY, high: float = MAX_DELAY) -> Column:
    """Cancelled, or each delay is NULL or within the bounds."""
    return (F.col("CANCELLED") == 1) | (in_range("DEP_DELAY", low, high) & in_range("ARR_DELAY", low, high))


def key_filter(flights: DataFrame) -> DataFrame:
    return flights.filter(has_keys())


def range_filter(flights: DataFrame, low: float = MIN_DELAY, high: float = MAX_DELAY) -> DataFrame:
    return flights.filter(is_plausible(low, high))


def add_date_parts(flights: DataFrame) -> DataFrame:
    """FL_DATE as date (NULL if it is no date) with its month and year."""
    dated = flights.withColumn("FL_DATE", parse_date("FL_DATE"))
    return dated.withColumns({"MONTH": F.month("FL_DATE"), "YEAR": F.year("FL_DATE")})


def normalise_codes(flights: DataFrame) -> DataFrame:
    if "CANCELLATION_CODE" not in flights.columns:
        return flights
    return flights.withColumn("CANCELLATION_CODE", clean_code("CANCELLATION_CODE"))


def fill_delays(flights: DataFrame) -> DataFrame:
    """An operated flight without a recorded delay was on time; a cancelled one keeps its NULL."""
    operated = F.col("CANCELLED") == 0
    return flights.withColumns(
        {c: F.when(operated & F.col(c).isNull(), 0.0).otherwise(F.col(c)) for c in DELAY_COLUMNS}
    )


def clean_flights(raw: DataFrame, low: float = MIN_DELAY, high: float = MAX_DELAY) -> DataFrame:
    """All cleaning steps. One narrow pass over the raw rows, without a shuffle."""
    kept = range_filter(key_filter(parse_types(raw)), low, high)
    return fill_delays(normalise_codes(add_date_parts(kept)))


# What takes a row out, by stage.
REASONS = {
    "no_airport": "key_filter",
    "no_airline": "key_filter",
    "departure_delay": "range_filter",
    "arrival_delay": "range_filter",
    "other_month": "month_filter",
}


def _reason(low: float, high: float, month: tuple[int, int] | None) -> Column:
    """The first check that a parsed row fails, NULL for a row that stays."""
    operated = F.col("CANCELLED") != 1
    reason = (
        F.when(~has_text("ORIGIN"), "no_airport")
        .when(~has_text("OP_UNIQUE_CARRIER"), "no_airline")
        .when(operated & ~in_range("DEP_DELAY", low, high), "departure_delay")
        .when(operated & ~in_range("ARR_DELAY", low, high), "arrival_delay")
    )
    if month is None:
        return reason
    here = F.col("YEAR").eqNullSafe(F.lit(month[0])) & F.col("MONTH").eqNullSafe(F.lit(month[1]))
    return F.coalesce(reason, F.when(~here, "other_month"))


def cleaning_stages(
    raw: DataFrame, low: float = MIN_DELAY, high: float = MAX_DELAY, month: tuple[int, int] | None = None
) -> DataFrame:
    """All rows, cleaned, with the stage that keeps them or takes them out: ``kept``, ``key_filter``, ``range_filter``.

    The rows of :func:`clean_flights` are those of stage ``kept``. The others have no values, but the reason and
    ``raw``, the text of all their columns, known and unknown, by normalised name, to be looked at or cleaned
    again; they lie under the month of their date. As nothing is filtered, every value is parsed once, and a table
    written by stage tells its own counts.

    With a ``month`` (year, month) all rows lie under it, and those of another or no date are taken out
    by stage ``month_filter``.
    """
    named = normalise_headers(raw)
    kept_as = {c: f"_raw {c}" for c in named.columns}
    rows = named.select("*", *[F.col(f"`{c}`").cast("string").alias(name) for c, name in kept_as.items()])
    texts = F.create_map(*[v for c, name in kept_as.items() for v in (F.lit(c), F.col(f"`{name}`"))])
    parsed = parse_types(rows, [f"`{name}`" for name in kept_as.values()])
    dated = normalise_codes(add_date_parts(parsed))
    cleaned = fill_delays(dated.withColumn("reason", _reason(low, high, month)))
    kept = F.col("reason").isNull()
    stage = F.lit("kept")
    for reason, name in REASONS.items():
        stage = F.when(F.col("reason") == reason, name).otherwise(stage)
    values = [F.when(kept, F.col(c)).alias(c) for c in cleaned.columns if c in RAW_COLUMNS]
    parts = PARTITION_COLUMNS if month is None else [F.lit(v).alias(c) for c, v in zip(PARTITION_COLUMNS, month)]
    return cleaned.select(*values, "reason", F.when(~kept, texts).alias("raw"), stage.alias("stage"), *parts)


def quarantine_report(stages: DataFrame) -> DataFrame:
    """Rows that were taken out, by reason and by the raw text of what the checks read."""
    read = ["ORIGIN", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY", "CANCELLED"]
    out = stages.filter(F.col("reason").isNotNull())
    return out.groupBy("reason", *[F.try_element_at("raw", F.lit(c)).alias(c) for c in read]).agg(F.count("*").alias("rows"))


def stage_report(stages: DataFrame) -> DataFrame:
    """The counts of :func:`cleaning_report` from a table with a stage per row, such as one written by stage."""
    dated = F.col("stage") != "month_filter"
    counts = stages.agg(
        F.count_if(dated).alias("raw"),
        F.count_if(dated & (F.col("stage") != "key_filter")).alias("keyed"),
        F.count_if(F.col("stage") == "kept").alias("kept"),
    )
    return _report(counts)


def cleaning_report(raw: DataFrame, low: float = MIN_DELAY, high: float = MAX_DELAY) -> DataFrame:
    """Rows left and rows removed per stage: ``stage, rows_left, rows_removed``.

    One conditional aggregate counts all stages in a single scan.
    """
    counts = parse_types(raw).agg(
        F.count("*").alias("raw"),
        F.count_if(has_keys()).alias("keyed"),
        F.count_if(has_keys() & is_plausible(low, high)).alias("kept"),
    )
    return _report(counts)


def _report(counts: DataFrame) -> DataFrame:
    def stage(name: str, left: str, before: str) -> Column:
        removed = F.col(before) - F.col(left)
        return F.struct(F.lit(name).alias("stage"), F.col(left).alias("rows_left"), removed.alias("rows_removed"))

    stages = F.array(
        stage("raw", "raw", "raw"), stage("key_filter", "keyed", "raw"), stage("range_filter", "kept", "keyed")
    )
    return counts.select(F.inline(stages))
