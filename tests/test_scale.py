from __future__ import annotations

import hashlib
import re

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from skyledger import fixtures
from skyledger.operators import make_subset, numbered_subset
from tests.support import flight_table, rows

# Java does not compile a method of more bytes of bytecode; each row of it is interpreted.
HUGE_METHOD = 8000


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    lines = spark.range(300).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 4 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "IF(id % 3 = 0, 'R', 'N') AS l_returnflag", "TIMESTAMP_NTZ '1995-03-04 00:00:00' AS l_shipdate",
    )
    tables = {
        "lineitem": lines.unionAll(lines.limit(20)),
        "part": spark.range(7).selectExpr("id AS p_partkey", "IF(id = 6, NULL, concat('Brand#', id)) AS p_brand"),
        "supplier": spark.range(5).selectExpr("id AS s_suppkey", "CAST(id AS INT) AS s_nationkey"),
        "nation": spark.range(5).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name"),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["tolerant_select", "subset_200", "subset_hashed_025", "anomaly_ranking_joined", "delay_report_joined", "clean_flights"]
)
def test_no_method_is_too_large_for_java_to_compile(spark, order_tables, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = entry.queries()[name](spark, order_tables)._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < HUGE_METHOD


def test_raw_flights_are_those_of_the_sql(spark, order_tables):
    tables = fixtures._tables(spark, order_tables, ["lineitem", "supplier", "nation", "part"])
    plain, raw = spark.sql(fixtures.RAW_FLIGHTS_SQL, **tables), fixtures.raw_flights(spark, order_tables)
    assert rows(raw) == rows(plain) and raw.schema.simpleString() == plain.schema.simpleString()


def test_sample_facts_read_the_table_once(spark):
    table = flight_table(spark, *[{"OP_CARRIER_FL_NUM": str(n // 2), "DEST": None if n % 5 else "LAX"} for n in range(3000)])
    found = entry._sample_facts(50)(table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in found.collect()] == [(3000, True, 0, 0)]
    assert [tuple(r) for r in entry._sample_facts(50)(table.limit(0)).collect()] == [(0, True, 0, 0)]


@pytest.mark.parametrize("wrong", ["unknown", "changed"])
def test_sample_facts_see_wrong_samples(spark, monkeypatch, wrong):
    calls = []

    def sample(table, percent):
        calls.append(percent)
        if wrong == "unknown":
            return table.unionAll(table) if len(calls) == 1 else table
        half = F.pmod(F.xxhash64("row"), F.lit(2))
        return table.filter(half == 0) if len(calls) == 1 else table.filter("false")

    table = flight_table(spark, *[{"OP_CARRIER_FL_NUM": str(n)} for n in range(300)])
    monkeypatch.setattr(entry.ops, "make_subset", sample)
    found = entry._sample_facts(50)(table).first()
    if wrong == "unknown":
        assert tuple(found) == (300, False, 300, 300)
    else:
        assert found["unknown_rows"] == 0 and 100 < found["changed_rows"] < 200


def test_numbered_subset_shuffles_no_text_and_only_what_stays(spark):
    table = make_subset(flight_table(spark, *[{"OP_CARRIER_FL_NUM": str(n)} for n in range(400)]), 200)
    plan = numbered_subset(table, 25)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan)
    assert len(keys) == 2 and not any("text" in k for k in keys)
    dealt = plan.index("REPARTITION_BY_COL")
    assert "md5" in plan[dealt:]


def test_numbered_subset_tells_signs_of_zero_apart(spark):
    changes = [{"OP_CARRIER_FL_NUM": str(n), "NAS_DELAY": zero} for n in range(300) for zero in (0.0, -0.0, -0.0)]
    table = flight_table(spark, *changes)
    found = numbered_subset(table, 50)
    def stays(number, zero, copy):
        values = list(table.first())
        values[table.columns.index("OP_CARRIER_FL_NUM")], values[table.columns.index("NAS_DELAY")] = str(number), zero
        text = "|".join("<null>" if v is None else str(v) for v in [*values, copy])
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) * 100 < 50 << 32

    expected = sum(stays(n, z, c) for n in range(300) for z, c in ((0.0, 1), (-0.0, 1), (-0.0, 2)))
    assert found.count() == expected
