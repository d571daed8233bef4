"""Stored layouts of the clickstream that later jobs profit from.

By date: a folder for each day, so that a job on a range of days, or on days that come out of
another table, opens only theirs. By session: a fixed number of buckets, rows sorted by session and time
in each; the roll-up, the semi join on kept sessions and everything else that works by session then
need no shuffle of the actions. A session is in one bucket whole: where one may hold a large part of
all rows, the layout by date is the one to take, whose shuffles split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 200


def write_by_date(actions: DataFrame, path: str) -> None:
    """Replace the days that `actions` holds; other days at `path` stay."""
    # Files of an even size, also when one day holds most rows.
    rows = actions.hint("rebalance", "date")
    writer = rows.write.mode("overwrite").partitionBy("date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_by_date(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """`schema` names the columns; the date stays the text that it was."""
    return spark.read.schema(schema).parquet(path)


def write_by_session(actions: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Replace the catalog table `table`. Each bucket is one file, written by one task."""
    dealt = actions.repartition(buckets, "session_id")
    writer = dealt.write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "session_id").sortBy("session_id", "action_time").saveAsTable(table)


def days_of(actions: DataFrame, days: DataFrame) -> DataFrame:
    """Actions of the days in another frame (column `date`); on the layout by date only these are read."""
    return actions.join(days.select("date").distinct(), "date", "left_semi")
