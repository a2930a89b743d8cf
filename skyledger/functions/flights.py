"""Column expressions on flights. All of them are built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band and label names are result data and stay as they are.
BAND_LOW, BAND_MEDIUM, BAND_HIGH = "basso", "medio", "alto"
LABEL_WORSE, LABEL_BETTER, LABEL_NORMAL = "ANOMALO_PEGGIORE", "ANOMALO_MIGLIORE", "NELLA_NORMA"
NO_CODE = "N/A"


def has_text(name: str) -> Column:
    """Not NULL and not blank."""
    return F.col(name).isNotNull() & (F.trim(name) != "")


def flag_to_int(name: str) -> Column:
    """``true``, or any text that reads as the number one, gives 1; all else and NULL gives 0.

    The test is made on the raw text, because under ANSI rules a cast of ``true`` to a number fails.
    """
    text = F.lower(F.trim(name))
    return F.when((text == "true") | (text.try_cast("double") == 1.0), 1).otherwise(0)


def clean_code(name: str) -> Column:
    """Upper-cased and trimmed, ``N/A`` for NULL."""
    return F.coalesce(F.upper(F.trim(name)), F.lit(NO_CODE))


def parse_date(name: str) -> Column:
    """A date written as ``yyyy-MM-dd``; anything else gives NULL.

    The cast alone would also take ``2024-1-5`` or ``2024``; a parse by pattern costs twice as much.
    """
    return F.when(F.col(name).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(name).try_cast("date"))


def in_range(name: str, low: float, high: float) -> Column:
    """NULL, or between the bounds, which belong to the range."""
    return F.col(name).isNull() | F.col(name).between(low, high)


def delay_band(name: str = "DEP_DELAY", low: float = 15, high: float = 60) -> Column:
    """``basso`` for NULL or below ``low``, ``medio`` up to and with ``high``, else ``alto``."""
    delay = F.col(name)
    return F.when(delay.isNull() | (delay < low), BAND_LOW).when(delay <= high, BAND_MEDIUM).otherwise(BAND_HIGH)


def anomaly_label(diff: Column, threshold: float = 15.0) -> Column:
    """Label of a difference in minutes; the bounds themselves, and NULL, are normal."""
    return (
        F.when(diff > threshold, LABEL_WORSE)
        .when(diff < -threshold, LABEL_BETTER)
        .otherwise(LABEL_NORMAL)
    )


def round2(value: Column) -> Column:
    """Two decimals, half up on the printed value."""
    return F.round(value, 2)


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals."""
    return round2(part / whole * 100)
