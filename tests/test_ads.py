from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.operators import ads
from clickloom.sources.adlog import parse_ad_log

MINUTE = 60_000
START = 1_588_327_200_000  # 2020-05-01 10:00:00 UTC


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def log(spark, *clicks):
    """Clicks of (minutes after the start, province, city, user, ad)."""
    return parse_ad_log(lines(spark, *[
        f"{START + m * MINUTE} {p} {c} {u} {a}" for m, p, c, u, a in clicks
    ]))


def test_parse(spark):
    parsed = parse_ad_log(lines(
        spark, f"{START + 61_001} 3 33 7 9", "broken", "x 1 2 3 4", "1 1 1 user 1", ""))
    row = parsed.select("*", F.unix_millis("ts").alias("ms")).collect()
    assert len(row) == 1
    assert row[0].asDict() | {"ts": None} == {
        "date": "20200501", "minute_key": "202005011001", "ts": None, "province": "3",
        "city": "33", "userid": 7, "adid": 9, "ms": START + 61_001,
    }
    assert dict(parsed.dtypes)["userid"] == "bigint"


def test_blacklist_default_threshold_is_passed_not_met(spark):
    clicks = [(0, 1, 1, 5, 9)] * 101 + [(0, 1, 1, 6, 9)] * 100 + [(0, 1, 1, 7, a) for a in range(150)]
    counts = ads.user_ad_clicks(log(spark, *clicks))
    assert rows_of(ads.users_over(counts)) == [(5,)]
    listed = ads.users_over(counts)
    left = ads.not_blacklisted(log(spark, *clicks), listed)
    assert left.count() == 250 and left.where("userid = 5").count() == 0


def test_counts_are_per_day(spark):
    day = 24 * 60
    counts = ads.user_ad_clicks(log(spark, (0, 1, 1, 5, 9), (day, 1, 1, 5, 9), (day, 1, 1, 5, 9)))
    assert rows_of(counts) == [("20200501", 5, 9, 1), ("20200502", 5, 9, 2)]
    assert rows_of(ads.users_over(counts, 1)) == [(5,)]


def test_lookup_gives_zero_for_unknown_keys(spark):
    counts = ads.user_ad_clicks(log(spark, (0, 1, 1, 5, 9)))
    keys = spark.createDataFrame(
        [("20200501", 5, 9), ("20200501", 5, 8)], "date string, userid bigint, adid bigint")
    assert rows_of(ads.click_counts_of(keys, counts)) == [
        ("20200501", 5, 8, 0), ("20200501", 5, 9, 1)
    ]


def test_province_top_three_adds_cities_up(spark):
    clicks = [(0, 1, city, 1, ad) for ad, n in ((1, 2), (2, 3), (3, 2), (4, 2)) for city in range(n)]
    stat = ads.ad_stat(log(spark, *clicks, (0, 2, 1, 1, 8)))
    assert stat.count() == 10
    assert rows_of(ads.province_top_ads(stat)) == [
        ("20200501", "1", 1, 2), ("20200501", "1", 2, 3), ("20200501", "1", 3, 2),
        ("20200501", "2", 8, 1),
    ]


def test_trend_per_minute(spark):
    trend = ads.click_trend(log(spark, (0, 1, 1, 1, 4), (0, 2, 2, 2, 4), (61, 1, 1, 1, 4)))
    assert trend.columns == ["date", "hour", "minute", "adid", "clickCount"]
    assert rows_of(trend) == [("20200501", "10", "00", 4, 2), ("20200501", "11", "01", 4, 1)]


def test_sliding_hour_equals_window_over_each_click(spark):
    clicks = log(spark, *[(i * i % 150, 1, 1, 1, i % 3) for i in range(80)])
    window = clicks.groupBy(F.window("ts", "60 minutes", "1 minute"), "adid").count()
    want = window.select(F.date_format("window.start", "yyyyMMddHHmm"), "adid", "count")
    assert rows_of(ads.sliding_hour(clicks)) == rows_of(want)


@pytest.mark.parametrize("minute, windows", [(0, 60)])
def test_a_click_lies_in_sixty_windows(spark, minute, windows):
    assert ads.sliding_hour(log(spark, (minute, 1, 1, 1, 1))).count() == windows


def test_windows_are_made_once(spark):
    """Each row of the result comes out of one pass over the steps: no copies are counted again."""
    plan = ads.sliding_hour(log(spark, (0, 1, 1, 1, 1)))._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Generate explode(sequence", 1)
    assert "HashAggregate" not in before and "HashAggregate" in after
