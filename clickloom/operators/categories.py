"""Popular categories and the sessions most active in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.texts import id_list
from clickloom.operators.ranks import RANK, broadcast_up_to, ranked
from clickloom.sources.tables import NO_CLICK


def _category_touches(actions: DataFrame, *keep: str) -> DataFrame:
    """One row per category that an action clicks, orders or pays: category_id, kind.

    Clicks, orders and payments come out of one scan; an action may do several.
    """
    def tagged(ids: Column, kind: str) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("category_id"), F.lit(kind).alias("kind")))

    touching = (
        (F.col("click_category_id") != NO_CLICK)
        | F.col("order_category_ids").isNotNull()
        | F.col("pay_category_ids").isNotNull()
    )
    none = F.array().cast("array<bigint>")
    clicked = F.when(F.col("click_category_id") != NO_CLICK, F.array("click_category_id"))
    touches = F.concat(
        tagged(F.coalesce(clicked, none), "click"),
        tagged(F.coalesce(id_list(F.col("order_category_ids")), none), "order"),
        tagged(F.coalesce(id_list(F.col("pay_category_ids")), none), "pay"),
    )
    return actions.where(touching).select(*keep, F.inline(touches))


def category_event_counts(actions: DataFrame) -> DataFrame:
    """Count of each kind of touch per category, one row per (category_id, kind) seen."""
    return (
        _category_touches(actions)
        .groupBy("category_id", "kind")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def _counted(touches: DataFrame, *keys: str) -> DataFrame:
    return touches.groupBy(*keys).agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def category_full_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of every category touched in any of the three ways.

    Combined before the shuffle, so a category that holds most rows is one row per task.
    """
    return _counted(_category_touches(actions), "category_id")


def session_category_counts(actions: DataFrame) -> DataFrame:
    """The same counts per session and category."""
    return _counted(_category_touches(actions, "session_id"), "session_id", "category_id")


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The `n` categories with most clicks, then orders, then payments; ties by smaller id."""
    top = counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(n)
    return broadcast_up_to(top, n)


def category_session_clicks(
    actions: DataFrame, top: DataFrame, kept: DataFrame | None = None
) -> DataFrame:
    """Clicks of each (kept) session in each top category.

    `top` is a list of a few categories and cuts the scan to their clicks. Clicks are counted per
    session before sessions are filtered: the join sees one row per session and category, however
    long the session is.
    """
    counted = (
        actions.where(F.col("click_category_id") != NO_CLICK)
        .select("session_id", F.col("click_category_id").alias("category_id"))
        .join(top.select("category_id"), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    if kept is None:
        return counted
    return counted.join(kept.select("session_id"), "session_id", "left_semi").select(
        "category_id", "session_id", "click_count"
    )


def top_sessions(clicks: DataFrame, n: int = 10) -> DataFrame:
    """The `n` sessions with most clicks of each category; ties by smaller session id."""
    order = [F.desc("click_count"), "session_id"]
    return ranked(clicks, ["category_id"], order, n, "session_id").drop(RANK)


def top_category_report(top: DataFrame, task_id: str) -> DataFrame:
    return top.select(
        F.lit(task_id).alias("taskid"),
        F.col("category_id").alias("categoryid"),
        F.col("click_count").alias("clickCount"),
        F.col("order_count").alias("orderCount"),
        F.col("pay_count").alias("payCount"),
    )


def top_session_report(top: DataFrame, task_id: str) -> DataFrame:
    return top.select(
        F.lit(task_id).alias("taskid"),
        F.col("category_id").alias("categoryid"),
        F.col("session_id").alias("sessionid"),
        F.col("click_count").alias("clickCount"),
    )
