"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# For large scans: fewer, bigger tasks keep the number of partial aggregates per key low. Shuffles start
# with many partitions, which adaptive execution merges, or splits if skewed, to the advisory size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def session(app_name: str) -> SparkSession:
    """A session with :data:`SETTINGS`; what ``spark-submit`` set, and a session that runs already, stay as they are."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name that every executor can reach.

    It lies under the cluster's ``spark.checkpoint.dir``; a session without that setting uses its
    warehouse folder. On a cluster that has neither elsewhere than in a local folder, this is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.conf.get("spark.master", "local").startswith("local") and urlsplit(shared).scheme in ("", "file"):
            raise ValueError(f"spark.checkpoint.dir is not set, and executors may not share {shared}")
    return f"{shared.rstrip('/')}/skyledger-{uuid.uuid4().hex}"
