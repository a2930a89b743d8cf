from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("skyledger-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Tests look for folders in plans, which Spark would cut after 100 characters.
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def raw(spark, sf_dir, tmp_path_factory):
    """Raw flights as a stored table."""
    from skyledger import fixtures
    from skyledger.schemas import RAW_FLIGHTS

    path = str(tmp_path_factory.mktemp("tables") / "raw")
    fixtures.raw_flights(spark, sf_dir).write.parquet(path)
    return spark.read.schema(RAW_FLIGHTS).parquet(path)


@pytest.fixture(scope="session")
def flights(spark, raw, tmp_path_factory):
    """Cleaned flights as a stored table."""
    from skyledger.operators import clean_flights
    from skyledger.sinks import write_clustered
    from skyledger.sources import read_flights

    path = str(tmp_path_factory.mktemp("tables") / "cleaned")
    write_clustered(clean_flights(raw), path)
    return read_flights(spark, path)
