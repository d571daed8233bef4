"""Running sums over ordered groups of any size.

Rows fall into buckets of the order. The buckets are summed, and a running sum over these sums is
where a bucket's own running sum begins. Only the few rows of a bucket are sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096


def digest_bucket(key: str, buckets: int) -> Column:
    """Bucket of a hexadecimal digest by its first 28 bits: digests are even, so buckets are."""
    head = F.conv(F.substring(key, 1, 7), 16, 10).cast("bigint")
    return F.floor(head * buckets / (1 << 28))


def bucket_starts(marked: DataFrame, value: Column, within: Sequence[str]) -> DataFrame:
    """For each `_bucket` of each group: _start, the sum before it, _sum, its own, and _total."""
    sums = marked.groupBy(*within, "_bucket").agg(F.sum(value).alias("_sum"))
    # A row for each bucket, BUCKET_ROWS times fewer than rows.
    whole = Window.partitionBy(*within)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *within, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
        "_sum", F.sum("_sum").over(whole).alias("_total"),
    )


def running(
    rows: DataFrame, order: Sequence[str], bucket: Column, value: Column, target: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds `target`, the sum of `value` up to and with the row, and `_total`, the whole sum.

    Each group of the columns `within`, which must not be null, has its own sums. `bucket` must
    rise with the order.
    """
    marked = rows.withColumn("_bucket", bucket)
    starts = bucket_starts(marked, value, within).drop("_sum")
    inside = (
        Window.partitionBy(*within, "_bucket").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marked.withColumn("_up_to", F.sum(value).over(inside)).join(starts, [*within, "_bucket"])
        .withColumn(target, F.col("_start") + F.col("_up_to"))
        .drop("_bucket", "_up_to", "_start")
    )
