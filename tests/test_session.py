from __future__ import annotations


import pytest

from skyledger.session import scratch_dir, session


class Settings:
    """Just enough of a session to ask for settings."""

    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_a_running_session_is_used_as_it_is(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session("other") is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_lies_in_the_shared_folder():
    cluster = Settings(spark_master="yarn", **{"spark_checkpoint_dir": "hdfs://host/shared/"})
    assert scratch_dir(cluster).startswith("hdfs://host/shared/skyledger-")


def test_without_the_setting_scratch_lies_in_the_warehouse():
    shared = Settings(spark_master="yarn", spark_sql_warehouse_dir="hdfs://host/tables")
    assert scratch_dir(shared).startswith("hdfs://host/tables/skyledger-")
    local = Settings(spark_master="local[2]", spark_sql_warehouse_dir="file:/tables")
    assert scratch_dir(local).startswith("file:/tables/skyledger-")
    for place in ("file:/tables", "/tables"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(Settings(spark_master="yarn", spark_sql_warehouse_dir=place))
