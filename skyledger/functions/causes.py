"""The leading causes of delay of one row that carries one total per cause."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Total column and label per cause. The order decides ties.
CAUSES = {
    "carrier_val": "Carrier",
    "weather_val": "Weather",
    "nas_val": "NAS",
    "security_val": "Security",
    "late_aircraft_val": "Late Aircraft",
}


def top_causes(k: int = 3) -> Column:
    """The ``k`` largest positive totals as ``array<struct<cause, impact>>``, largest first. NaN is not positive."""
    entries = [
        F.when((F.col(total) > 0) & ~F.isnan(total), F.struct(F.col(total).alias("impact"), F.lit(-place).alias("turn"), F.lit(label).alias("cause")))
        for place, (total, label) in enumerate(CAUSES.items())
    ]
    largest_first = F.sort_array(F.array_compact(F.array(*entries)), asc=False)
    return F.transform(
        F.slice(largest_first, 1, k),
        lambda e: F.struct(e["cause"].alias("cause"), e["impact"].alias("impact")),
    )


def causes_text(causes: Column) -> Column:
    """``[('Carrier', 3134.0), ('NAS', 12.5)]``, or ``[]``.

    A number has the fewest digits that tell it from all others, at least one of them behind the point.
    From 10^7 on, where a double's own text begins to use an exponent, it is written out as long as a decimal
    holds it. No number is ever NULL, which would drop its entry.
    """

    def entry(e: Column) -> Column:
        own = e["impact"].cast("string")
        written = F.regexp_replace(e["impact"].try_cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
        number = F.when(e["impact"] >= 1e7, F.coalesce(written, own)).otherwise(own)
        return F.concat(F.lit("('"), e["cause"], F.lit("', "), number, F.lit(")"))

    return F.concat(F.lit("["), F.array_join(F.transform(causes, entry), ", "), F.lit("]"))
