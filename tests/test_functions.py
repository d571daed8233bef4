from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from clickloom.functions import numbers, texts, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text, parsed", [
    ("2020-05-01 5:07:09", "2020-05-01 05:07:09"),
    ("2020-05-01 15:07:09", "2020-05-01 15:07:09"),
    ("no time", None),
])
def test_parse_time_reads_both_hour_widths(spark, text, parsed):
    assert one(spark, times.format_time(times.parse_time(F.lit(text)))) == parsed


def test_date_parts(spark):
    t = F.lit("2020-05-01 5:07:09")
    ts = times.parse_time(t)
    assert one(spark, times.format_date(ts)) == "2020-05-01"
    assert one(spark, times.date_key(ts)) == "20200501"
    assert one(spark, times.minute_key(ts)) == "202005010507"
    assert one(spark, times.date_hour(t)) == "2020-05-01_5"
    assert str(one(spark, times.parse_date_key(F.lit("20200501")))) == "2020-05-01"
    assert one(spark, times.parse_date_key(F.lit("2020"))) is None


def test_comparisons(spark):
    early, late = F.lit("2020-05-01 9:00:00"), F.lit("2020-05-01 10:00:01")
    assert one(spark, times.is_before(early, late)) is True
    assert one(spark, times.is_after(early, late)) is False
    assert one(spark, times.seconds_between(late, early)) == 3601
    assert one(spark, times.seconds_between(early, late)) == -3601


def test_today_and_yesterday_follow_the_given_day(spark):
    day = F.to_date(F.lit("2020-03-01"))
    assert one(spark, times.today(day)) == "2020-03-01"
    assert one(spark, times.yesterday(day)) == "2020-02-29"
    assert one(spark, times.today()) is not None


@pytest.mark.parametrize("text, empty", [(None, True), ("", True), (" ", False), ("a", False)])
def test_emptiness(spark, text, empty):
    c = F.lit(text).cast("string")
    assert one(spark, texts.is_empty(c)) is empty
    assert one(spark, texts.is_not_empty(c)) is not empty


@pytest.mark.parametrize("text, trimmed", [
    (",a,b,", "a,b"), ("a,b", "a,b"), ("a,", "a"), (",a", "a"), (",,", ""), ("", ""),
])
def test_trim_comma(spark, text, trimmed):
    assert one(spark, texts.trim_comma(F.lit(text))) == trimmed


@pytest.mark.parametrize("text, padded", [("7", "07"), ("17", "17"), ("", "0"), ("123", "0123")])
def test_two_digits(spark, text, padded):
    assert one(spark, texts.two_digits(F.lit(text))) == padded


@pytest.mark.parametrize("record, field, value", [
    ("a=1|b=2", "b", "2"),
    ("a=1|b=2", "c", None),
    ("a=|b=2", "a", None),
    ("a=1=2|a=3", "a", "3"),
    ("a=1|a=2", "a", "1"),
    ("a=1=|b=2", "a", "1"),
    ("=1|b", "", "1"),
    ("", "a", None),
    ("ab=1|b=2", "b", "2"),
])
def test_packed_field(spark, record, field, value):
    assert one(spark, texts.packed_field(F.lit(record), "|", field)) == value


@pytest.mark.parametrize("record, result", [
    ("a=1|b=2", "a=1|b=9"),
    ("b=2", "b=9"),
    ("a=1|c=3", "a=1|c=3"),
    ("b=1|a=1|b=2", "a=1|b=9"),
])
def test_set_packed_field(spark, record, result):
    assert one(spark, texts.set_packed_field(F.lit(record), "|", "b", "9")) == result


@pytest.mark.parametrize("json, value", [
    ('{"product_status": 0}', "0"), ('{"product_status": "x"}', "x"),
    ('{"other": 1}', None), ("not json", None),
])
def test_json_field(spark, json, value):
    assert one(spark, texts.json_field(F.lit(json), "product_status")) == value


@pytest.mark.parametrize("text, ids", [
    ("1,2", [1, 2]), ("5", [5]), ("1,x,3", [1, 3]), ("", []), (None, None),
])
def test_id_list(spark, text, ids):
    assert one(spark, texts.id_list(F.lit(text).cast("string"))) == ids


def test_distinct_list_compares_whole_values(spark):
    ids = spark.createDataFrame([(12,), (1,), (2,), (1,), (None,)], "v bigint")
    assert ids.agg(texts.distinct_list(F.col("v"))).first()[0] == "1,2,12"
    cities = spark.createDataFrame([("11:A",), ("1:A",), ("1:A",)], "v string")
    assert cities.agg(texts.distinct_list(F.col("v"))).first()[0] == "11:A,1:A"
    assert cities.where("false").agg(texts.distinct_list(F.col("v"))).first()[0] is None


def test_share_rounds_half_up_for_every_count(spark):
    top = 240
    frame = spark.range(1, top).withColumnRenamed("id", "d").select(
        "d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("d"))).alias("n"))
    for n, d, got in frame.select("n", "d", numbers.share(F.col("n"), F.col("d"))).collect():
        exact = (Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got == float(exact), (n, d)


def test_share_of_nothing_is_null(spark):
    assert one(spark, numbers.share(F.lit(0), F.lit(0))) is None
    assert one(spark, numbers.share(F.lit(10**12 * 3), F.lit(10**12 * 7))) == 0.43


@pytest.mark.parametrize("x, rounded", [(0.285, 0.29), (0.125, 0.13), (2.0, 2.0), (-0.125, -0.13)])
def test_format_double(spark, x, rounded):
    assert one(spark, numbers.format_double(F.lit(x), 2)) == rounded
