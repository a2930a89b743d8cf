"""Flights and run times derived from the order tables, for checks and benchmarks.

One line item is one flight, the supplier's nation is the airport, the part's brand is the airline. The
text is plain SQL, so that another engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import clean_flights

RAW_FLIGHTS_SQL = """
SELECT
 CASE WHEN l_orderkey % 997 = 0 THEN 'not-a-date' ELSE substr(CAST(l_shipdate AS STRING), 1, 10) END AS FL_DATE,
 CASE WHEN l_orderkey % 503 = 0 THEN ' ' WHEN l_orderkey % 509 = 0 THEN NULL ELSE p_brand END AS OP_UNIQUE_CARRIER,
 CAST(l_partkey AS STRING) AS OP_CARRIER_FL_NUM,
 CASE WHEN l_orderkey % 601 = 0 THEN '' WHEN l_orderkey % 607 = 0 THEN NULL ELSE n_name END AS ORIGIN,
 CONCAT('NATION_', CAST(l_partkey % 25 AS STRING)) AS DEST,
 CASE WHEN canc = 1 AND l_linenumber <> 2 THEN NULL WHEN l_orderkey % 401 = 0 THEN '1501.0'
      WHEN l_orderkey % 409 = 0 THEN '-121.0' WHEN l_orderkey % 307 = 0 THEN NULL
      ELSE CONCAT(CAST(dep AS STRING), '.0') END AS DEP_DELAY,
 CASE WHEN canc = 1 OR l_orderkey % 311 = 0 THEN NULL
      ELSE CONCAT(CAST(dep - 2 * l_linenumber AS STRING), '.0') END AS ARR_DELAY,
 CASE WHEN canc = 1 THEN CASE l_linenumber % 3 WHEN 0 THEN '1' WHEN 1 THEN '1.0' ELSE 'true' END
      ELSE CASE WHEN l_orderkey % 313 = 0 THEN NULL ELSE '0.0' END END AS CANCELLED,
 CASE WHEN canc = 1 AND l_orderkey % 11 <> 0
      THEN CASE l_orderkey % 4 WHEN 0 THEN ' a' WHEN 1 THEN 'B' WHEN 2 THEN 'c ' ELSE 'D' END
      ELSE NULL END AS CANCELLATION_CODE,
 CASE WHEN canc = 0 AND dep >= 15 THEN CONCAT(CAST(l_partkey % 40 AS STRING), CASE WHEN l_orderkey % 5 = 0 THEN '.25' ELSE '.0' END) ELSE NULL END AS CARRIER_DELAY,
 CASE WHEN canc = 0 AND dep >= 15 THEN CONCAT(CAST(l_suppkey % 7 AS STRING), '.0') ELSE NULL END AS WEATHER_DELAY,
 CASE WHEN canc = 0 AND dep >= 15 THEN CONCAT(CAST(l_orderkey % 30 AS STRING), '.0') ELSE NULL END AS NAS_DELAY,
 CASE WHEN canc = 0 AND dep >= 15
      THEN CASE WHEN l_orderkey % 97 = 0 THEN '5.0' ELSE '0.0' END ELSE NULL END AS SECURITY_DELAY,
 CASE WHEN canc = 0 AND dep >= 15
      THEN CONCAT(CAST(l_orderkey % 45 AS STRING), '.0') ELSE NULL END AS LATE_AIRCRAFT_DELAY
FROM (
 SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, p_brand, n_name,
  CASE WHEN (l_returnflag = 'R' AND l_linenumber <= 3) OR (p_brand = 'Brand#3' AND s_nationkey % 5 = 0)
       THEN 1 ELSE 0 END AS canc,
  CAST(l_quantity AS INT) * 4 - 60
   + CASE WHEN p_brand = 'Brand#7' AND s_nationkey % 3 = 0 THEN 90
          WHEN p_brand = 'Brand#11' AND s_nationkey % 4 = 0 THEN -40 ELSE 0 END AS dep
 FROM {lineitem}
 JOIN (SELECT s_suppkey, s_nationkey, n_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey) s
   ON l_suppkey = s_suppkey
 JOIN {part} ON l_partkey = p_partkey) x
"""

# Quarter seconds, so that sums of them are exact in any order. Subsets beside the usual four, as any can be logged.
TIMINGS_SQL = """
SELECT
 CASE event_id % 3 WHEN 0 THEN 'job31' WHEN 1 THEN 'job32' ELSE 'job33' END AS job,
 CASE user_id % 3 WHEN 0 THEN 'spark_sql' WHEN 1 THEN 'spark_core' ELSE 'hive' END AS technology,
 CASE event_id % 6 WHEN 0 THEN 'pct_025' WHEN 1 THEN 'pct_050' WHEN 2 THEN 'pct_100' WHEN 3 THEN 'pct_200'
      WHEN 4 THEN 'pct_010' ELSE 'full' END AS subset,
 CASE WHEN event_id % 5 < 2 THEN 'local' ELSE 'aws' END AS environment,
 CAST(20 + user_id % 90 + (event_id % 7) / 4.0 AS DOUBLE) AS elapsed_seconds,
 event_id AS record_count
FROM {events}
"""

TABLES = ["lineitem", "supplier", "nation", "part", "events"]


def _tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights, all text, with dirty values in every column, straight from the given tables."""
    return _worked_out(spark.sql(RAW_FLIGHTS_SQL, **_tables(spark, sf_dir, ["lineitem", "supplier", "nation", "part"])))


def _worked_out(table: DataFrame) -> DataFrame:
    """The same rows, each column worked out once per row, as if it had been read.

    Spark would move later filters below the columns and work out a column again wherever a filter names it. For the
    text above that gives methods beyond the 8,000 bytes of bytecode up to which Java compiles, so every row
    would be interpreted. It moves no filter below a generator.
    """
    return table.select(F.inline(F.array(F.struct(*table.columns))))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, cleaned."""
    return clean_flights(raw_flights(spark, sf_dir))


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run time log with one entry per event."""
    return spark.sql(TIMINGS_SQL, **_tables(spark, sf_dir, ["events"]))


def plain_sql(text: str) -> str:
    """The same text with bare table names."""
    return text.format(**{name: name for name in TABLES})
