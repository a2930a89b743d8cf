"""Table schemas: the raw and cleaned flights and every result table."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw columns that are kept, in table order.
RAW_COLUMNS = [
    "FL_DATE",
    "OP_UNIQUE_CARRIER",
    "OP_CARRIER_FL_NUM",
    "ORIGIN",
    "DEST",
    "DEP_DELAY",
    "ARR_DELAY",
    "CANCELLED",
    "CANCELLATION_CODE",
    "CARRIER_DELAY",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

DELAY_COLUMNS = ["DEP_DELAY", "ARR_DELAY"]

CAUSE_COLUMNS = [
    "CARRIER_DELAY",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

PARTITION_COLUMNS = ["YEAR", "MONTH"]


_DATE, _TEXT, _INT, _LONG, _DOUBLE = T.DateType(), T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_FLIGHTS = _schema(**{c: _TEXT for c in RAW_COLUMNS})

# Delays and causes are stored as double: sums over them are double anyway and
# a float column would turn 14.99 into 14.989999771.
FLIGHTS = _schema(
    FL_DATE=_DATE,
    OP_UNIQUE_CARRIER=_TEXT,
    OP_CARRIER_FL_NUM=_TEXT,
    ORIGIN=_TEXT,
    DEST=_TEXT,
    DEP_DELAY=_DOUBLE,
    ARR_DELAY=_DOUBLE,
    CANCELLED=_INT,
    CANCELLATION_CODE=_TEXT,
    CARRIER_DELAY=_DOUBLE,
    WEATHER_DELAY=_DOUBLE,
    NAS_DELAY=_DOUBLE,
    SECURITY_DELAY=_DOUBLE,
    LATE_AIRCRAFT_DELAY=_DOUBLE,
    YEAR=_INT,
    MONTH=_INT,
)

# The same rows with the cleaning stage that keeps them, or takes them out, as their first folder. A row that was taken
# out has no values but its month, and a reason and its raw text by column.
STAGES = T.StructType([
    *FLIGHTS.fields[:-2],
    T.StructField("reason", _TEXT),
    T.StructField("raw", T.MapType(_TEXT, _TEXT)),
    T.StructField("stage", _TEXT),
    *FLIGHTS.fields[-2:],
])

PARTIALS = _schema(
    airport=_TEXT,
    airline=_TEXT,
    delay_band=_TEXT,
    flights=_LONG,
    cancelled=_LONG,
    arr_sum=_DOUBLE,
    arr_count=_LONG,
    arr_min=_DOUBLE,
    arr_max=_DOUBLE,
    dep_zero_sum=_DOUBLE,
    arr_zero_sum=_DOUBLE,
    dep_operated_sum=_DOUBLE,
    dep_operated_count=_LONG,
    arr_operated_sum=_DOUBLE,
    arr_operated_count=_LONG,
    carrier_val=_DOUBLE,
    weather_val=_DOUBLE,
    nas_val=_DOUBLE,
    security_val=_DOUBLE,
    late_aircraft_val=_DOUBLE,
    months=_INT,
    YEAR=_INT,
    MONTH=_INT,
)

AIRLINE_STATS = _schema(
    airline=_TEXT,
    airport=_TEXT,
    total_flights=_LONG,
    min_arr_delay=_DOUBLE,
    max_arr_delay=_DOUBLE,
    avg_arr_delay=_DOUBLE,
    cancellation_rate_pct=_DOUBLE,
    active_months=T.ArrayType(_INT),
)

DELAY_REPORT = _schema(
    airport=_TEXT,
    month=_INT,
    avg_arr_delay=_DOUBLE,
    avg_dep_delay=_DOUBLE,
    delay_band=_TEXT,
    flight_count=_LONG,
    top3_causes=_TEXT,
)

ANOMALY_RANKING = _schema(
    airport=_TEXT,
    airline=_TEXT,
    flight_count=_LONG,
    avg_dep_delay=_DOUBLE,
    avg_arr_delay=_DOUBLE,
    cancellation_rate_pct=_DOUBLE,
    airport_avg_dep_delay=_DOUBLE,
    airport_total_flights=_LONG,
    dep_delay_diff=_DOUBLE,
    rank_in_airport=_INT,
    anomaly_label=_TEXT,
)

TIMINGS = _schema(
    job=_TEXT,
    technology=_TEXT,
    subset=_TEXT,
    environment=_TEXT,
    elapsed_seconds=_DOUBLE,
    record_count=_LONG,
)

# An entry of the log as it is stored, with the run that wrote it.
LOGGED = T.StructType([*TIMINGS.fields, T.StructField("run_id", _TEXT)])
