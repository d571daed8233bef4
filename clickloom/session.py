"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day, hour and minute keys are UTC, whatever zone the session came with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app: str, **settings: str) -> SparkSession:
    """A session with the settings the jobs count on.

    Sizes (executors, memory, `spark.sql.shuffle.partitions`) and `spark.checkpoint.dir`
    belong to the cluster; they are left as given.
    """
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # No call-site capture for every column expression: plans are built faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
