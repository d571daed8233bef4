"""Random sample of sessions, spread over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.times import format_date
from clickloom.operators.ranks import RANK, broadcast_up_to, ranked
from clickloom.operators.sessions import session_rollup


def hour_quotas(sessions: DataFrame, total: int) -> DataFrame:
    """Rows to draw from each (date, hour): at most `total` rows, one per hour with a quota.

    Each day gets `total div days`; each hour its share of the day's sessions, rounded down.
    """
    hours = _dated(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count"))
    days = hours.agg(F.nullif(F.count_distinct("date"), F.lit(0)).alias("days")).scalar()
    per_day = F.call_function("div", F.lit(total), days)
    day_count = F.sum("hour_count").over(Window.partitionBy("date"))
    quota = F.call_function("div", F.col("hour_count") * F.col("per_day"), F.col("day_count"))
    return (
        hours.withColumn("day_count", day_count)
        .withColumn("per_day", per_day)
        .withColumn("quota", F.least(quota, F.col("hour_count")))
        .where(F.col("quota") > 0)
        .select("date", "hour", "hour_count", "day_count", "quota")
    )


def sample_sessions(sessions: DataFrame, total: int = 100, seed: str = "") -> DataFrame:
    """Draw each hour's quota without repeats; the seed decides which sessions.

    The quotas sum up to `total` at most, so their table has at most `total` rows, and no hour
    needs more than its first `total` sessions.
    """
    quotas = hour_quotas(sessions, total).select("date", "hour", "quota")
    candidates = _dated(sessions).join(broadcast_up_to(quotas, total), ["date", "hour"])
    order = [F.md5(F.concat("session_id", F.lit(seed))), "session_id"]
    return ranked(candidates, ["date", "hour"], order, total, "session_id", "quota").drop(RANK)


def session_extract(
    actions: DataFrame, sessions: DataFrame, task_id: str, total: int = 100, seed: str = ""
) -> DataFrame:
    """Sampled sessions with start time, keywords and categories.

    Keyword and category sets are built for the drawn sessions only: at most `total` ids meet a
    second scan of the actions.
    """
    drawn = sample_sessions(sessions, total, seed).select("session_id")
    drawn = broadcast_up_to(drawn, total)
    details = session_rollup(actions.join(drawn, "session_id", "left_semi"))
    return details.select(
        F.lit(task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        F.col("start_time").alias("startTime"),
        F.col("search_keywords").alias("searchKeywords"),
        F.col("click_category_ids").alias("clickCategoryIds"),
    )


def _dated(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", "start_ts",
        format_date("start_ts").alias("date"), F.date_format("start_ts", "HH").alias("hour"),
    )
