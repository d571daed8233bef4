from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from replay import replay

from clickloom.operators import ads
from clickloom.sinks.keyed import KeyedTable
from clickloom.sources.adlog import file_lines, parse_ad_log
from clickloom.streaming import ads as live
from clickloom.streaming.tables import AdTables

START = 1_588_327_200_000


def feed(spark, n=300, seed=3):
    """Lines over some hours and two days, in no order, with their times."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ms = START + rng.randrange(30 * 3600 * 1000)
        rows.append((ms, f"{ms} {rng.randrange(3)} {rng.randrange(5)} "
                         f"{rng.randrange(4)} {rng.randrange(6)}"))
    return spark.createDataFrame(rows, "ms bigint, value string").select(
        F.timestamp_millis("ms").alias("ts"), "value")


def run(start, lines, tables, path, **options):
    start(lines, tables, f"{path}/checkpoint", available_now=True, **options).awaitTermination()


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_job_equals_batch_however_the_feed_is_cut(spark, tmp_path, batches):
    lines = feed(spark)
    tables = AdTables(f"{tmp_path}/tables")
    stream = replay(lines, f"{tmp_path}/feed", batches)
    run(live.start_ad_job, stream, tables, tmp_path, threshold=10_000)
    log = parse_ad_log(lines)
    stat = ads.ad_stat(log)
    assert rows_of(tables.user_clicks.read(spark)) == rows_of(ads.user_ad_clicks(log))
    assert rows_of(tables.stat.read(spark)) == rows_of(stat)
    assert rows_of(tables.top3.read(spark)) == rows_of(ads.province_top_ads(stat))
    assert rows_of(tables.trend.read(spark)) == rows_of(ads.click_trend(log))
    assert tables.blacklist.read(spark).count() == 0


@pytest.mark.parametrize("batches", [1, 4])
def test_parts_of_the_job_equal_batch(spark, tmp_path, batches):
    lines = feed(spark)
    tables = AdTables(f"{tmp_path}/tables")
    stream = replay(lines, f"{tmp_path}/feed", batches)
    run(live.start_ad_stat, stream, tables, f"{tmp_path}/a", with_top3=True)
    run(live.start_click_trend, stream, tables, f"{tmp_path}/b")
    run(live.start_sliding_hour, stream, tables, f"{tmp_path}/c")
    log = parse_ad_log(lines)
    stat = ads.ad_stat(log)
    assert rows_of(tables.stat.read(spark)) == rows_of(stat)
    assert rows_of(tables.top3.read(spark)) == rows_of(ads.province_top_ads(stat))
    assert rows_of(tables.trend.read(spark)) == rows_of(ads.click_trend(log))
    assert rows_of(live.sliding_hours(spark, tables)) == rows_of(ads.sliding_hour(log))


def test_no_click_is_lost_when_parts_have_uneven_files(spark, tmp_path):
    """14 files of the first third of the time, then one of each other third, two a batch; the
    last batches bring the oldest lines."""
    folder, lines = f"{tmp_path}/feed", feed(spark, 400).persist()
    hour = 3600 * 1000
    part = F.floor((F.unix_millis("ts") - START) / (10 * hour))
    for number, files in ((2, 1), (1, 1), (0, 14)):
        rows = lines.where(part == number).select("value")
        rows.repartition(files).write.mode("append").text(folder)
    tables = AdTables(f"{tmp_path}/tables")
    stream = file_lines(spark, folder, files_per_batch=2)
    run(live.start_click_trend, stream, tables, f"{tmp_path}/a")
    run(live.start_sliding_hour, stream, tables, f"{tmp_path}/b")
    log = parse_ad_log(lines)
    assert rows_of(tables.trend.read(spark)) == rows_of(ads.click_trend(log))
    assert rows_of(live.sliding_hours(spark, tables)) == rows_of(ads.sliding_hour(log))
    lines.unpersist()


def test_processing_time_trigger_goes_on_until_stopped(spark, tmp_path):
    folder, tables = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables")
    write_lines(spark, folder, f"{START} 1 1 1 1")
    query = live.start_click_trend(file_lines(spark, folder), tables, f"{tmp_path}/checkpoint")
    try:
        query.processAllAvailable()
        write_lines(spark, folder, f"{START} 1 1 1 1")
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows_of(tables.trend.read(spark)) == [("20200501", "10", "00", 1, 2)]


def write_lines(spark, path, *lines):
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.mode(
        "append").text(path)


def test_blacklist_feeds_back_into_later_batches(spark, tmp_path):
    folder, tables = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables")

    def arrive(n, user=5):
        write_lines(spark, folder, *[f"{START} 1 1 {user} 9"] * n)
        run(live.start_ad_job, file_lines(spark, folder), tables, tmp_path)

    arrive(100)
    assert rows_of(tables.blacklist.read(spark)) == []
    arrive(1)
    assert rows_of(tables.blacklist.read(spark)) == [(5,)]
    arrive(5)
    arrive(2, user=6)
    assert rows_of(tables.user_clicks.read(spark)) == [("20200501", 5, 9, 101), ("20200501", 6, 9, 2)]
    assert rows_of(tables.stat.read(spark)) == [("20200501", "1", "1", 9, 103)]
    assert rows_of(tables.blacklist.read(spark)) == [(5,)]


def test_offenders_are_found_across_batches(spark, tmp_path):
    """The set of listed users is that of the whole feed, however it is cut."""
    lines = feed(spark, 400)
    want = rows_of(ads.users_over(ads.user_ad_clicks(parse_ad_log(lines)), 14))
    assert 0 < len(want)
    for batches in (1, 5):
        root = f"{tmp_path}/{batches}"
        tables = AdTables(f"{root}/tables")
        run(live.start_blacklist, replay(lines, f"{root}/feed", batches), tables, root, threshold=14)
        assert rows_of(tables.blacklist.read(spark)) == want


def test_replayed_batch_changes_nothing(spark, tmp_path):
    tables = AdTables(f"{tmp_path}/tables")
    clicks = [parse_ad_log(part) for part in feed(spark).select("value").randomSplit([1.0, 1.0], 1)]

    def process(log, batch_id):
        clean = ads.not_blacklisted(log, tables.blacklist.read(spark, before=batch_id))
        live.update_blacklist(clean, batch_id, tables, 8)
        tables.stat.write_batch(ads.ad_stat(clean), batch_id)
        live.update_top3(spark, batch_id, tables)

    def state():
        return [rows_of(t.read(spark)) for t in
                (tables.user_clicks, tables.blacklist, tables.stat, tables.top3)]

    process(clicks[0], 0)
    process(clicks[1], 1)
    once = state()
    assert once[1]
    process(clicks[1], 1)
    assert state() == once


def test_keys_of_a_batch_are_not_broadcast(spark, tmp_path, monkeypatch):
    seen, read = [], KeyedTable.read

    def spied(self, *args, only=None, **named):
        found = read(self, *args, only=only, **named)
        if only is not None:
            seen.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(KeyedTable, "read", spied)
    tables = AdTables(f"{tmp_path}/tables")
    live.update_blacklist(parse_ad_log(feed(spark)), 0, tables, 8)
    assert len(seen) == 1 and seen[0].count("LeftSemi") == seen[0].count("strategy=merge") > 0


def test_late_line_is_counted_in_its_own_minute(spark, tmp_path):
    folder = f"{tmp_path}/feed"
    hour = 3600 * 1000
    job, trend = AdTables(f"{tmp_path}/job"), AdTables(f"{tmp_path}/trend")
    for at in (START, START + 5 * hour, START):
        write_lines(spark, folder, f"{at} 1 1 1 1")
        run(live.start_ad_job, file_lines(spark, folder), job, f"{tmp_path}/a")
        run(live.start_click_trend, file_lines(spark, folder), trend, f"{tmp_path}/b")
    late = [("20200501", "10", "00", 1, 2), ("20200501", "15", "00", 1, 1)]
    assert rows_of(job.trend.read(spark)) == late
    assert rows_of(trend.trend.read(spark)) == late


def with_arrival(spark, n=200):
    """Lines that come up to two hours late."""
    rng = random.Random(9)
    late = F.udf(lambda _: rng.randrange(120), "int")  # tests only
    rows = feed(spark, n).withColumn("arrived", F.timestamp_add("MINUTE", late("value"), "ts"))
    return spark.createDataFrame(rows.collect(), "ts timestamp, value string, arrived timestamp")


def test_hour_by_arrival_holds_what_came_in_the_last_hour(spark):
    lines = with_arrival(spark)
    log = parse_ad_log(lines, "arrived")
    want = {}
    for r in log.collect():
        pane = r.arrived.replace(second=0, microsecond=0)
        for later in range(60):
            at = (pane + timedelta(minutes=later)).strftime("%Y%m%d%H%M")
            key = (at, r.minute_key[:8], r.minute_key[8:10], r.minute_key[10:], r.adid)
            want[key] = want.get(key, 0) + 1
    panes = ads.arrival_panes(log)
    assert {tuple(r)[:5]: r.clickCount for r in ads.arrival_hour(panes).collect()} == want
    since = max(want)[0]
    start = datetime.strptime(since, "%Y%m%d%H%M") - timedelta(minutes=30)
    some = ads.arrival_hour(panes, F.lit(start).cast("timestamp"))
    first = start.strftime("%Y%m%d%H%M")
    assert {tuple(r)[:5]: r.clickCount for r in some.collect()} == {
        k: n for k, n in want.items() if k[0] >= first}


def test_arrival_stream(spark, tmp_path):
    lines, folder = with_arrival(spark), f"{tmp_path}/feed"
    lines.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    tables = AdTables(f"{tmp_path}/tables")
    run(live.start_arrival_hour, stream, tables, tmp_path)
    want = ads.arrival_hour(ads.arrival_panes(parse_ad_log(lines, "arrived")))
    assert rows_of(live.arrival_reports(spark, tables)) == rows_of(want)
    since = lines.agg(F.max("arrived")).first()[0].replace(minute=0, second=0, microsecond=0)
    some = live.arrival_reports(spark, tables, since)
    first = since.strftime("%Y%m%d%H%M")
    assert rows_of(some) == rows_of(want.where(F.col("report_minute") >= first))


def test_lines_without_arrival_get_the_time_of_their_batch(spark, tmp_path):
    folder, tables = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables")
    write_lines(spark, folder, f"{START} 1 1 1 1", f"{START} 1 1 1 1")
    run(live.start_arrival_hour, file_lines(spark, folder), tables, tmp_path)
    found = live.arrival_reports(spark, tables).collect()
    assert len(found) == 60 and {r.clickCount for r in found} == {2}


def test_running_stat_goes_on_after_a_restart(spark, tmp_path):
    """Counts are kept in the state store; every batch reports all keys of the last days."""
    folder, tables, reports = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables"), []
    lines = feed(spark, 200).persist()
    hour = 3600 * 1000

    def report(counts, batch_id):
        reports.append(counts.agg(F.sum("clickCount")).first()[0])

    for part in range(3):  # a new query each time, from the same checkpoint
        due = F.floor((F.unix_millis("ts") - START) / (10 * hour)) == part
        lines.where(due).select("value").coalesce(1).write.mode("append").text(folder)
        run(live.start_running_stat, file_lines(spark, folder), tables, tmp_path, report=report)
    assert rows_of(tables.running_stat.read(spark)) == rows_of(ads.ad_stat(parse_ad_log(lines)))
    assert reports[-1] == 200 and sorted(reports) == reports
    assert spark.conf.get(live.STATE_STORE) != live.ROCKSDB
    assert list((tmp_path / "checkpoint" / "state").rglob("*.zip"))  # snapshots of RocksDB
    lines.unpersist()


def test_running_stat_ends_a_day_after_its_day(spark, tmp_path):
    folder, tables = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables")
    day = 24 * 3600 * 1000
    for at in (START, START + 3 * day, START, START + 3 * day):
        write_lines(spark, folder, f"{at} 1 1 1 1")
        run(live.start_running_stat, file_lines(spark, folder), tables, tmp_path)
    assert rows_of(tables.running_stat.read(spark)) == [
        ("20200501", "1", "1", 1, 1), ("20200504", "1", "1", 1, 2)]


def test_kafka_source_needs_its_connector(spark):
    """The connector is not on this machine; the reader must ask for it by its name."""
    from pyspark.errors import AnalysisException

    from clickloom.sources.adlog import kafka_lines

    with pytest.raises(AnalysisException, match="kafka"):
        kafka_lines(spark, "localhost:9092", "realtime")
