"""Replays a finished table as a feed: text files that arrive in the order of time."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.folders import hadoop_path
from clickloom.sources.adlog import file_lines


def replay(lines: DataFrame, path: str, batches: int = 3) -> DataFrame:
    """Stream of the column `value`, cut by `ts` into about `batches` micro-batches.

    Parts are written one after the other, because a file source reads files by age, and a
    watermark drops rows that come out of order.
    """
    spark = lines.sparkSession
    low, high = lines.agg(
        F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))
    ).first()
    step = ceil((high - low + 1) / batches) if low is not None else 1
    start = low or 0
    for i in range(batches):
        since = F.timestamp_micros(F.lit(start + i * step))
        until = F.timestamp_micros(F.lit(start + (i + 1) * step))
        part = lines.where((F.col("ts") >= since) & (F.col("ts") < until))
        part.select("value").write.mode("append").text(path)
    fs, pattern = hadoop_path(spark, f"{path}/part-*")
    files = len(fs.globStatus(pattern) or [])
    return file_lines(spark, path, max(1, ceil(files / batches)))
