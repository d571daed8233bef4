"""The ad-click feed: text lines `timestamp province city userid adid`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import date_key, minute_key


def kafka_lines(spark: SparkSession, brokers: str, topic: str, **options: str) -> DataFrame:
    """Stream of lines from Kafka, from the latest offset on.

    The read position lives in the checkpoint of the query, nothing is committed to the brokers.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Stream of lines from text files that arrive in a folder."""
    reader = spark.readStream.format("text").options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value")


def parse_ad_log(
    lines: DataFrame, *kept: str, observation: Observation | str | None = None
) -> DataFrame:
    """Typed columns of each line, and the columns `kept`; works on streams and on batches.

    A line whose numbers cannot be read is left out. An observation, or the name of one in the progress
    of a stream, counts on the way: `lines`, and `unreadable`, those left out.
    """
    part = F.split("value", " ")
    ts = F.timestamp_millis(F.get(part, F.lit(0)).try_cast("bigint"))
    typed = lines.select(
        ts.alias("ts"),
        F.get(part, F.lit(1)).alias("province"),
        F.get(part, F.lit(2)).alias("city"),
        F.get(part, F.lit(3)).try_cast("bigint").alias("userid"),
        F.get(part, F.lit(4)).try_cast("bigint").alias("adid"),
        *kept,
    )
    needed = ["ts", "userid", "adid"]
    if observation is not None:
        unreadable = F.count_if(F.greatest(*[F.col(c).isNull() for c in needed]))
        typed = typed.observe(
            observation, F.count(F.lit(1)).alias("lines"), unreadable.alias("unreadable")
        )
    typed = typed.dropna(subset=needed)
    return typed.select(
        date_key("ts").alias("date"), minute_key("ts").alias("minute_key"), *typed.columns
    )
