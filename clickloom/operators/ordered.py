"""Neighbours and running counts inside ordered groups of any size.

A window over a whole group puts the group into one task, so one session or user with a third
of all rows would hold up the job. Groups are therefore measured first, by counts of hash buckets, which
combine before they shuffle: whatever the number of groups, there are `BUCKETS` counts. A group whose bucket
is not far above the mean has one plain window.

Time is cut twice in the others. Rows meet in windows of one second of
a group. Each second then is one row with its edges; seconds meet in windows of one hour, at most 3600
rows, and hours in a window over the group.
A group with very many rows within an hour, or even within minutes, is cut as well as one that spans a
month. The results are those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND, HOUR = 1, 3600
NO_TIME = -(1 << 62)
# Groups are measured in so many buckets; one is hot with twice the mean and `HOT_ROWS` more, so fewer than
# half of them are.
BUCKETS = 1 << 16
HOT_ROWS = 100_000


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of the time slice that holds `ts`; rows without a time have one of their own."""
    return F.coalesce(F.floor(F.unix_seconds(ts) / seconds), F.lit(NO_TIME))


def _by_heat(rows: DataFrame, group: str, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups that fit into one task, and those of groups that may not, if there are any.

    This counts the rows at once; the numbers of the hot buckets are all that comes to the driver.
    """
    bucket = F.pmod(F.xxhash64(group), F.lit(BUCKETS)).cast("int")
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    measured = counts.agg(F.collect_list(F.struct("_bucket", "n")).alias("all"), F.sum("n").alias("sum"))
    hot = measured.select(F.filter(
        "all", lambda b: b["n"] > F.col("sum") * 2 / BUCKETS + hot_rows
    )["_bucket"]).first()[0]
    if not hot:
        return rows, None
    listed = F.broadcast(rows.sparkSession.createDataFrame([(b,) for b in hot], "_bucket int"))
    marked = rows.withColumn("_bucket", bucket)
    return tuple(marked.join(listed, "_bucket", how).drop("_bucket") for how in ("left_anti", "left_semi"))


def successor_pairs(
    rows: DataFrame,
    group: str,
    value: str,
    order: Sequence[str],
    ts: str,
    slice_seconds: int = SECOND,
    span_seconds: int = HOUR,
    with_last: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`value` of each row with the `value` of the next row of its group: (value, next_value).

    `order` must begin with `ts`. The last row of a group has no pair; `with_last` gives it one with
    null, so that every row is there once.
    """
    narrow = rows.select(group, value, *[c for c in order if c not in (group, value)])
    cool, hot = _by_heat(narrow, group, hot_rows)
    plain = _with_next(cool, [group], order, value, value)
    if not with_last:
        plain = plain.where("_more")
    plain = plain.select(value, F.col("_next").alias("next_value"))
    if hot is None:
        return plain
    return plain.unionByName(
        _sliced_pairs(hot, group, value, order, ts, slice_seconds, span_seconds, with_last)
    )


def _sliced_pairs(
    rows: DataFrame,
    group: str,
    value: str,
    order: Sequence[str],
    ts: str,
    slice_seconds: int,
    span_seconds: int,
    with_last: bool,
) -> DataFrame:
    sliced = rows.withColumn("_slice", time_slice(F.col(ts), slice_seconds))
    seen = _with_next(sliced, [group, "_slice"], order, value, value)
    pairs = seen.where("_more").select(value, F.col("_next").alias("next_value"))

    # Below each window its rows lie together already, so these sums need no shuffle of their own.
    span = F.floor(F.col("_slice") / F.lit(max(1, span_seconds // slice_seconds)))
    slices = _edges(seen, [group, "_slice"], value, value).withColumn("_span", span)
    met = _with_next(slices, [group, "_span"], ["_slice"], "_last", "_first")
    bridges = met.where("_more").select(F.col("_last").alias(value), F.col("_next").alias("next_value"))

    spans = _edges(met, [group, "_span"], "_first", "_last")
    jumps = _with_next(spans, [group], ["_span"], "_last", "_first")
    if not with_last:
        jumps = jumps.where("_more")
    return pairs.unionByName(bridges).unionByName(
        jumps.select(F.col("_last").alias(value), F.col("_next").alias("next_value"))
    )


def _with_next(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, next_value: str
) -> DataFrame:
    """Adds `_next`, the next row's `next_value`, `_more`, whether there is one, and `_begins`."""
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.select(
        "*",
        F.lead(next_value).over(window).alias("_next"),
        F.lead(F.lit(True)).over(window).isNotNull().alias("_more"),
        (F.row_number().over(window) == 1).alias("_begins"),
    )


def _edges(seen: DataFrame, group: Sequence[str], first: str, last: str) -> DataFrame:
    """One row per group of `seen`: the value of its first and of its last row."""
    return seen.groupBy(*group).agg(
        F.max(F.when(F.col("_begins"), F.col(first))).alias("_first"),
        F.max(F.when(~F.col("_more"), F.col(last))).alias("_last"),
    )


def gap_sessions(
    rows: DataFrame,
    group: str,
    ts: str,
    gap_seconds: int,
    slice_seconds: int = SECOND,
    span_seconds: int = HOUR,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `session_no`: 1 for the first row of a group, one more after each pause.

    A pause is `gap_seconds` or more between two rows that follow each other. A slice is
    shorter than a pause, so all its rows are of one session.
    """
    if gap_seconds <= slice_seconds:
        raise ValueError("a pause must be longer than a slice")

    def starts(current: str, previous: Column) -> Column:
        pause = F.unix_micros(current) - F.unix_micros(previous)
        return (previous.isNull() | (pause >= gap_seconds * 1_000_000)).cast("int")

    cool, hot = _by_heat(rows, group, hot_rows)
    in_time = Window.partitionBy(group).orderBy(ts)
    up_to_here = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timeless = F.col(ts).isNull() & (F.row_number().over(in_time) > 1)  # all in one slice
    opens = F.when(timeless, 0).otherwise(starts(ts, F.lag(ts).over(in_time)))
    plain = cool.withColumn("_starts", opens).withColumn(
        "session_no", F.sum("_starts").over(up_to_here)
    ).drop("_starts")
    if hot is None:
        return plain
    return plain.unionByName(
        _sliced_sessions(hot, group, ts, starts, slice_seconds, span_seconds)
    )


def _sliced_sessions(
    rows: DataFrame,
    group: str,
    ts: str,
    starts: Callable[[str, Column], Column],
    slice_seconds: int,
    span_seconds: int,
) -> DataFrame:
    sliced = rows.withColumn("_slice", time_slice(F.col(ts), slice_seconds))
    slices = sliced.groupBy(group, "_slice").agg(
        F.min(ts).alias("_from"), F.max(ts).alias("_to")
    ).withColumn("_span", F.floor(F.col("_slice") / F.lit(max(1, span_seconds // slice_seconds))))
    within = Window.partitionBy(group, "_span").orderBy("_slice")
    first = F.row_number().over(within) == 1
    counted = (
        slices.withColumn(
            "_starts", F.when(first, 0).otherwise(starts("_from", F.lag("_to").over(within)))
        )
        .withColumn("_inside", F.sum("_starts").over(
            within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    spans = counted.groupBy(group, "_span").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_starts").alias("_within")
    )
    across = Window.partitionBy(group).orderBy("_span")
    so_far = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        spans.withColumn("_opens", starts("_from", F.lag("_to").over(across)))
        .withColumn("_base", F.sum(F.col("_opens") + F.col("_within")).over(so_far)
                    - F.col("_within"))
        .select(group, "_span", "_base")
    )
    numbers = counted.join(offsets, [group, "_span"]).select(
        group, "_slice", (F.col("_base") + F.col("_inside")).alias("session_no")
    )
    return sliced.join(numbers, [group, "_slice"]).drop("_slice")
