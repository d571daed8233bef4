"""The live ad job.

`start_ad_job` runs everything on one stream: each micro-batch drops blacklisted users, updates
the click counts, lists new offenders and refreshes statistics, province ranking and trend.
The other starters run single parts of it. A batch writes what it adds to the stored counts, so a late
line counts in its own minute, day and window, whenever it comes. Only `start_running_stat` keeps
streaming state, whose end of life is given.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.times import date_key
from clickloom.operators.ads import (
    DEFAULT_THRESHOLD,
    ad_stat,
    arrival_hour,
    arrival_panes,
    click_trend,
    hour_counts,
    hour_steps,
    named_hours,
    not_blacklisted,
    province_top_ads,
    user_ad_clicks,
    users_over,
)
from clickloom.sinks.keyed import KeyedTable
from clickloom.sources.adlog import parse_ad_log
from clickloom.streaming.tables import STAT_KEYS, AdTables

BATCH_INTERVAL = "5 seconds"
FOLD_EVERY = 50
# In the progress of every stream: how many lines came, and how many of them couldn't be read.
FEED = "feed"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A batch of so many days opens just their folders; one of more days opens the range of them.
MAX_DAYS = 366

BatchFunction = Callable[[DataFrame, int], None]


def start_ad_job(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    threshold: int = DEFAULT_THRESHOLD,
    available_now: bool = False,
) -> StreamingQuery:
    """Run the whole ad job on a stream of feed lines."""

    def on_batch(log: DataFrame, batch_id: int) -> None:
        spark = log.sparkSession
        clean = not_blacklisted(log, tables.blacklist.read(spark, before=batch_id)).persist()
        try:
            tables.stat.write_batch(ad_stat(clean), batch_id)
            update_top3(spark, batch_id, tables)
            tables.trend.write_batch(click_trend(clean), batch_id)
            # Last: writing the blacklist makes Spark drop what is cached and was read from it.
            update_blacklist(clean, batch_id, tables, threshold)
        finally:
            clean.unpersist()
        _keep_short(spark, batch_id, tables.all())

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def start_blacklist(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    threshold: int = DEFAULT_THRESHOLD,
    available_now: bool = False,
) -> StreamingQuery:
    """Only the feedback loop: filter, click counts, blacklist."""

    def on_batch(log: DataFrame, batch_id: int) -> None:
        spark = log.sparkSession
        clean = not_blacklisted(log, tables.blacklist.read(spark, before=batch_id))
        update_blacklist(clean, batch_id, tables, threshold)
        _keep_short(spark, batch_id, [tables.user_clicks, tables.blacklist])

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def start_user_clicks(
    lines: DataFrame, tables: AdTables, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Only the click counts per day, user and ad, without a blacklist."""

    def on_batch(log: DataFrame, batch_id: int) -> None:
        tables.user_clicks.write_batch(user_ad_clicks(log), batch_id)
        _keep_short(log.sparkSession, batch_id, [tables.user_clicks])

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def update_blacklist(
    clean: DataFrame, batch_id: int, tables: AdTables, threshold: int
) -> None:
    """Add a batch's clicks to the stored counts, then list the users they push over.

    The counts are written first and read back, so the batch is not computed twice. Of the
    stored counts only those of the batch's days and keys are added up.
    """
    spark = clean.sparkSession
    counts = tables.user_clicks
    counts.write_batch(user_ad_clicks(clean), batch_id)
    days = _days_of(counts.read_batch(spark, batch_id))
    if days is None:
        return
    # Its files are small for the rows they hold: by their size a large batch would be broadcast.
    touched = counts.read_batch(spark, batch_id).select(*counts.keys).hint("merge")
    stored = counts.read(spark, before=batch_id + 1, days=days, only=touched)
    over = users_over(stored, threshold)
    known = tables.blacklist.read(spark, before=batch_id)
    tables.blacklist.write_batch(over.join(known, "userid", "left_anti"), batch_id)


def update_top3(spark: SparkSession, batch_id: int, tables: AdTables) -> None:
    """Rank again the days and provinces whose counts the batch has changed."""
    changed = tables.stat.read_batch(spark, batch_id)
    days = _days_of(changed)
    if days is None:
        return
    groups = changed.select(*tables.top3.keys).distinct()
    stored = tables.stat.read(spark, before=batch_id + 1, days=days, only=groups)
    tables.top3.write_batch(province_top_ads(stored), batch_id)


def start_ad_stat(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    with_top3: bool = False,
    available_now: bool = False,
) -> StreamingQuery:
    """Clicks per day, province, city and ad, and the ranking of ads if wanted."""

    def on_batch(log: DataFrame, batch_id: int) -> None:
        spark = log.sparkSession
        tables.stat.write_batch(ad_stat(log), batch_id)
        touched = [tables.stat]
        if with_top3:
            update_top3(spark, batch_id, tables)
            touched.append(tables.top3)
        _keep_short(spark, batch_id, touched)

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def start_click_trend(
    lines: DataFrame, tables: AdTables, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Clicks per minute and ad."""

    def on_batch(log: DataFrame, batch_id: int) -> None:
        tables.trend.write_batch(click_trend(log), batch_id)
        _keep_short(log.sparkSession, batch_id, [tables.trend])

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def start_sliding_hour(
    lines: DataFrame, tables: AdTables, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Steps of the clicks per ad in every 60-minute window, one window starting each minute.

    `sliding_hours` reads the windows.
    """

    def on_batch(log: DataFrame, batch_id: int) -> None:
        steps = hour_steps(log).withColumn("date", date_key("start"))
        tables.hour_steps.write_batch(steps, batch_id)
        _keep_short(log.sparkSession, batch_id, [tables.hour_steps])

    return _start(parse_ad_log(lines, observation=FEED), on_batch, checkpoint, available_now)


def sliding_hours(spark: SparkSession, tables: AdTables) -> DataFrame:
    """window_start, adid, clickCount of all windows that have clicks."""
    return named_hours(hour_counts(tables.hour_steps.read(spark), "adid"))


def start_arrival_hour(
    lines: DataFrame, tables: AdTables, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Clicks of the last hour by time of arrival; `arrival_reports` reads the reports.

    A column `arrived` of the lines says when a line came. Without it that is the time of its
    micro-batch, which Spark keeps in the checkpoint: a batch that runs again has its old time.
    """
    if "arrived" not in lines.columns:
        lines = lines.withColumn("arrived", F.current_timestamp())

    def on_batch(log: DataFrame, batch_id: int) -> None:
        panes = arrival_panes(log).withColumn("date", date_key("pane"))
        tables.arrivals.write_batch(panes, batch_id)
        _keep_short(log.sparkSession, batch_id, [tables.arrivals])

    return _start(parse_ad_log(lines, "arrived", observation=FEED), on_batch, checkpoint, available_now)


def arrival_reports(
    spark: SparkSession, tables: AdTables, since: datetime | None = None
) -> DataFrame:
    """The report of each minute, from the time `since` on; only its days and the hour before are read."""
    if since is None:
        return arrival_hour(tables.arrivals.read(spark))
    first = F.lit(since).cast("timestamp")
    days = F.col("date") >= date_key(first - F.expr("INTERVAL 1 HOUR"))
    return arrival_hour(tables.arrivals.read(spark, days=days), first)


def start_running_stat(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    lives: str = "1 day",
    report: BatchFunction | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Running clicks per day, province, city and ad, kept as state in RocksDB.

    A day's counts live until the feed is `lives` past its end; lines that come later are dropped.
    Every batch writes the counts that it changed. `report` then gets the counts of all keys of the
    last two days, changed or not.
    """
    log = parse_ad_log(lines, observation=FEED).withWatermark("ts", lives)
    counts = log.groupBy(F.window("ts", "1 day"), *STAT_KEYS).agg(
        F.count(F.lit(1)).alias("clickCount")
    )

    def on_batch(changed: DataFrame, batch_id: int) -> None:
        spark, table = changed.sparkSession, tables.running_stat
        table.write_batch(changed.drop("window"), batch_id)
        if report is not None:
            recent = table.read(spark).agg(F.max("date").alias("last")).first()["last"]
            if recent is not None:
                since = F.date_format(F.date_sub(F.to_date(F.lit(recent), "yyyyMMdd"), 1), "yyyyMMdd")
                report(table.read(spark, days=F.col("date") >= since), batch_id)
        _keep_short(spark, batch_id, [table])

    conf = lines.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)  # a query takes its settings when it starts
    try:
        return _start(counts, on_batch, checkpoint, available_now, "update")
    finally:
        conf.set(STATE_STORE, before)


def _start(
    frame: DataFrame, on_batch: BatchFunction, checkpoint: str, available_now: bool,
    mode: str = "append",
) -> StreamingQuery:
    writer = frame.writeStream.foreachBatch(on_batch).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()


def _days_of(rows: DataFrame) -> Column | None:
    """A condition that opens only the folders of the days in a frame; None without rows."""
    days = [r["date"] for r in rows.select("date").distinct().limit(MAX_DAYS + 1).collect()]
    if not days:
        return None
    if len(days) <= MAX_DAYS:
        return F.col("date").isin(days)
    low, high = rows.agg(F.min("date"), F.max("date")).first()
    return F.col("date").between(low, high)


def _keep_short(spark: SparkSession, batch_id: int, tables: list[KeyedTable]) -> None:
    """Fold earlier batches now and then; this one may still run again and stays apart."""
    if (batch_id + 1) % FOLD_EVERY == 0:
        for t in tables:
            t.fold(spark, batch_id)
