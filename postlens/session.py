"""Session helpers of the tests, the tools and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "postlens",
                shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[8]")
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_buckets(spark: SparkSession, factor: int = 4) -> int:
    """Bucket count for distributed prefix sums: scales with the cluster."""
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        n = 200
    return max(8, n * factor)
