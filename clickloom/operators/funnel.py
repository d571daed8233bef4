"""Single-step conversion between pages along a target flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.numbers import share
from clickloom.operators.ordered import SECOND, successor_pairs
from clickloom.sources.tables import with_action_ts

Flow = str | Sequence[int]


def flow_pages(flow: Flow) -> list[int]:
    pages = flow.rstrip(",").split(",") if isinstance(flow, str) else flow
    return [int(p) for p in pages]


def target_pairs(spark: SparkSession, flow: Flow) -> DataFrame:
    """Steps of the flow in order: pos (from 0), page_pair."""
    pages = F.array(*[F.lit(p).cast("string") for p in flow_pages(flow)])
    steps = F.transform(
        F.slice(pages, 2, F.size(pages)),
        lambda page, i: F.concat_ws("_", F.get(pages, i), page),
    )
    return spark.range(1).select(F.posexplode(steps).alias("pos", "page_pair"))


def _next_pages(
    actions: DataFrame, tie_breakers: Sequence[str], slice_seconds: int
) -> DataFrame:
    """Counts of page_id and the page after it in the session, null after the last one."""
    pairs = successor_pairs(
        with_action_ts(actions), "session_id", "page_id", ["action_ts", *tie_breakers],
        "action_ts", slice_seconds, with_last=True,
    )
    return pairs.groupBy("page_id", "next_value").agg(F.count(F.lit(1)).alias("pair_count"))


def _of_flow(counted: DataFrame, flow: Flow) -> DataFrame:
    pages = flow_pages(flow)
    wanted = sorted({f"{a}_{b}" for a, b in zip(pages, pages[1:])})
    pair = F.concat(F.col("page_id").cast("string"), F.lit("_"), F.col("next_value").cast("string"))
    return counted.select(pair.alias("page_pair"), "pair_count").where(
        F.col("page_pair").isin(wanted)
    )


def page_pair_counts(
    actions: DataFrame,
    flow: Flow,
    tie_breakers: Sequence[str] = ("page_id",),
    slice_seconds: int = SECOND,
) -> DataFrame:
    """How often each step of the flow happens in a session: page_pair, pair_count.

    Actions of one session are ordered by time; `tie_breakers` order those of the same second.
    Steps that never happen have no row.
    """
    return _of_flow(_next_pages(actions, tie_breakers, slice_seconds), flow)


def start_page_views(actions: DataFrame, flow: Flow) -> DataFrame:
    """Views of the first page of the flow, one row."""
    return actions.where(F.col("page_id") == flow_pages(flow)[0]).agg(
        F.count(F.lit(1)).alias("start_page_pv")
    )


def page_convert_rates(
    actions: DataFrame,
    flow: Flow,
    tie_breakers: Sequence[str] = ("page_id",),
    slice_seconds: int = SECOND,
) -> DataFrame:
    """Per step: pos, page_pair, pair_count, base_count, convert_rate.

    The base of the first step is the number of start-page views, of each later step the count
    of the step before. A step never taken has count 0; a base of 0 gives a null rate.
    """
    steps = target_pairs(actions.sparkSession, flow)
    # Every action is there once, as a page before another or as the last one of its session, so
    # one pass gives the steps and the views of the start page.
    counted_pages = _next_pages(actions, tie_breakers, slice_seconds)
    counts = _of_flow(counted_pages, flow)
    start = counted_pages.where(F.col("page_id") == flow_pages(flow)[0]).agg(
        F.coalesce(F.sum("pair_count"), F.lit(0)).alias("pair_count")
    ).select(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("page_pair"), "pair_count")
    counted = steps.join(F.broadcast(counts), "page_pair", "left").select(
        "pos", "page_pair", F.coalesce("pair_count", F.lit(0).cast("bigint")).alias("pair_count")
    )
    # One window over all rows: there is one row per step of the flow.
    in_order = Window.orderBy("pos")
    return (
        start.unionByName(counted)
        .withColumn("base_count", F.lag("pair_count").over(in_order))
        .where(F.col("pos") >= 0)
        .withColumn("convert_rate", share(F.col("pair_count"), F.col("base_count")))
    )


def page_split_convert_rate(rates: DataFrame, task_id: str) -> DataFrame:
    """All rates as one text `pair=rate|pair=rate` in flow order; null rates stay empty."""
    step = F.struct("pos", "page_pair", "convert_rate")
    entries = F.transform(
        F.array_sort(F.collect_list(step)),
        lambda s: F.concat_ws(
            "=", s["page_pair"], F.coalesce(s["convert_rate"].cast("string"), F.lit(""))
        ),
    )
    return rates.agg(F.array_join(entries, "|").alias("convertRate")).select(
        F.lit(task_id).alias("taskid"), "convertRate"
    )
