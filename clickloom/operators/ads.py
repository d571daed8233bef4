"""Ad clicks, on parsed lines (see `sources.adlog`). All functions take a batch frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.times import minute_key
from clickloom.operators.joins import rows_without
from clickloom.operators.ranks import RANK, ranked

DEFAULT_THRESHOLD = 100
MINUTES_PER_HOUR = 60


def not_blacklisted(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Lines of users that are not on the list.

    The list grows, so it carries no broadcast hint: its size decides.
    """
    return rows_without(log, blacklist, "userid")


def user_ad_clicks(log: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return log.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("clickCount"))


def users_over(counts: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Users with more than `threshold` clicks on one ad in one day."""
    return counts.where(F.col("clickCount") > threshold).select("userid").distinct()


def click_counts_of(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """Stored count of each (date, userid, adid) asked for, 0 when there is none."""
    on = ["date", "userid", "adid"]
    return keys.select(*on).join(counts.select(*on, "clickCount"), on, "left").fillna(
        0, subset=["clickCount"]
    )


def ad_stat(log: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return log.groupBy("date", "province", "city", "adid").agg(
        F.count(F.lit(1)).alias("clickCount")
    )


def province_top_ads(stat: DataFrame, n: int = 3) -> DataFrame:
    """The `n` most-clicked ads of each day and province; ties by smaller ad id."""
    by_province = stat.groupBy("date", "province", "adid").agg(
        F.sum("clickCount").alias("clickCount")
    )
    order = [F.desc("clickCount"), "adid"]
    return ranked(by_province, ["date", "province"], order, n, "adid").drop(RANK)


def minute_parts(minute: Column) -> list[Column]:
    """date, hour and minute columns of a `yyyyMMddHHmm` text."""
    return [
        F.substring(minute, 1, 8).alias("date"),
        F.substring(minute, 9, 2).alias("hour"),
        F.substring(minute, 11, 2).alias("minute"),
    ]


def click_trend(log: DataFrame) -> DataFrame:
    """Clicks per minute and ad."""
    counted = log.groupBy(F.window("ts", "1 minute"), "adid").agg(
        F.count(F.lit(1)).alias("clickCount")
    )
    return counted.select(*minute_parts(minute_key(F.col("window.start"))), "adid", "clickCount")


def hour_steps(log: DataFrame) -> DataFrame:
    """start, adid, step: how an ad's clicks of an hour change from one minute to the next.

    A pane holds the clicks of one minute. It enters the hour that starts 59 minutes before it and
    leaves with the hour that starts one minute after it. So a pane makes two rows, whatever the
    length of the window; steps of different batches add up.
    """
    pane = F.date_trunc("minute", "ts").alias("pane")
    panes = log.groupBy(pane, "adid").agg(F.count(F.lit(1)).alias("clicks"))
    return _steps(panes, F.col("pane") - _minutes(MINUTES_PER_HOUR - 1), "adid")


def hour_counts(steps: DataFrame, *keys: str) -> DataFrame:
    """start, keys, clickCount: the hour of each minute that has clicks.

    The count is the sum of all steps up to it. It stays until the next step, so that each row of the
    result is made once. The window holds at most one row for each minute of a key.
    """
    order = Window.partitionBy(*keys).orderBy("start")
    total = F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = steps.select(
        *keys, "start", total.alias("clickCount"),
        (F.lead("start").over(order) - _minutes(1)).alias("last"),
    ).where("clickCount <> 0")  # the last step of a key brings it to zero
    return runs.select(
        F.explode(F.sequence("start", "last", _minutes(1))).alias("start"), *keys, "clickCount"
    )


def sliding_hour(log: DataFrame) -> DataFrame:
    """Clicks per ad in every 60-minute window, one window starting each minute."""
    return named_hours(hour_counts(hour_steps(log), "adid"))


def named_hours(counts: DataFrame) -> DataFrame:
    return counts.select(minute_key("start").alias("window_start"), "adid", "clickCount")


def arrival_panes(log: DataFrame) -> DataFrame:
    """pane, minute_key, adid, clicks: lines by the minute they arrived in and their own minute."""
    pane = F.date_trunc("minute", "arrived").alias("pane")
    return log.groupBy(pane, "minute_key", "adid").agg(F.count(F.lit(1)).alias("clicks"))


def arrival_hour(panes: DataFrame, since: Column | None = None) -> DataFrame:
    """report_minute, date, hour, minute, adid, clickCount: what each minute's report holds.

    A line counts in the report of the minute it arrived in and of the 59 minutes after that,
    whatever its own time is; it is reported under its own minute. `since` keeps the reports from that
    minute on: panes of an hour before it have expired and are not read.
    """
    if since is not None:
        panes = panes.where(F.col("pane") > since - _minutes(MINUTES_PER_HOUR))
    keys = ("minute_key", "adid")
    reports = hour_counts(_steps(panes, F.col("pane"), *keys), *keys)
    if since is not None:
        reports = reports.where(F.col("start") >= since)
    return reports.select(
        minute_key("start").alias("report_minute"), *minute_parts(F.col("minute_key")), "adid",
        "clickCount",
    )


def _minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def _steps(panes: DataFrame, enters: Column, *keys: str) -> DataFrame:
    """Each pane counts from `enters` on, and an hour later no more."""
    changes = F.inline(F.array(
        F.struct(enters.alias("start"), F.col("clicks").alias("step")),
        F.struct((enters + _minutes(MINUTES_PER_HOUR)).alias("start"), (-F.col("clicks")).alias("step")),
    ))
    steps = panes.select(*keys, changes).groupBy("start", *keys).agg(F.sum("step").alias("step"))
    return steps.where("step <> 0")
