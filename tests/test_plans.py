"""The physical plans: what reaches the scan, what is broadcast, how hot keys are split."""

from __future__ import annotations

import re

import pytest
from conftest import TESTDATA, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as registered
from clickloom.operators import categories, joins, sampling, sessions
from clickloom.operators.ordered import successor_pairs
from clickloom.sources import retail
from clickloom.sources.tables import clicks_between, read_actions

SF = f"{TESTDATA}/sf0.001"


def planned(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scan_details(frame) -> str:
    query = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(query, "formatted")


def executed(frame) -> str:
    frame.collect()
    return planned(frame).split("== Initial Plan ==")[0]


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield change
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(q.__name__ for q in registered._QUERIES))
def test_no_query_multiplies_rows_of_two_tables(spark, name):
    if name in STREAMS:
        pytest.skip("runs a stream when built")
    plan = planned(registered.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


STREAMS = {"ad_user_click_count", "ad_blacklist", "ad_stat", "ad_province_top3", "ad_click_trend",
           "ad_click_lookup", "ad_click_sliding_hour_stream", "ad_click_arrival_hour_stream",
           "ad_running_stat", "ad_job_user_clicks", "ad_job_stat",
           "ad_job_province_top3", "ad_job_click_trend", "sink_round_trip"}


def test_batches_of_the_streams_multiply_no_rows(spark, tmp_path):
    """What a micro-batch of the ad job reads and writes, on stored tables with some days."""
    from clickloom.operators import ads
    from clickloom.streaming import ads as live
    from clickloom.streaming.tables import AdTables

    log = registered._log(spark, SF)
    tables = AdTables(f"{tmp_path}/tables")
    tables.stat.write_batch(ads.ad_stat(log), 0)
    tables.blacklist.write_batch(log.select("userid").limit(3), 0)
    changed = tables.stat.read_batch(spark, 0)
    stored = tables.stat.read(
        spark, before=1, days=live._days_of(changed), only=changed.select("date", "province").distinct())
    clean = ads.not_blacklisted(log, tables.blacklist.read(spark, before=1))
    for frame in (
        clean, ads.user_ad_clicks(clean), ads.ad_stat(clean), ads.click_trend(clean),
        ads.sliding_hour(clean), ads.province_top_ads(stored), ads.users_over(ads.user_ad_clicks(clean)),
    ):
        plan = planned(frame)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert "PartitionFilters: [" in planned(stored)


def test_date_range_and_click_condition_reach_the_scan(spark, actions, tmp_path):
    actions({"click_product_id": 1}).write.parquet(f"{tmp_path}/a")
    table = read_actions(spark, f"{tmp_path}/a")
    plan = scan_details(clicks_between(table, "2020-05-01", "2020-05-02"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(date,2020-05-01)" in pushed
    assert "LessThanOrEqual(date,2020-05-02)" in pushed
    assert "EqualTo(click_product_id,-1)" in pushed
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"date", "city_id", "click_product_id"}


def test_range_of_the_test_clickstream_reaches_the_stored_column(spark):
    plan = scan_details(registered.queries()["actions_date_range"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan


def test_session_shares_need_no_sets(spark):
    plan = planned(sessions.session_stat_ratio(registered._kept(spark, SF), "t"))
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan
    assert "SortAggregate" not in plan


def test_ranks_are_cut_before_the_shuffle(spark):
    for name, limit in (("top10_session", 10), ("area_top3_product", 3), ("session_extract", 900)):
        plan = planned(registered.queries()[name](spark, SF))
        assert re.search(rf"row_number\(\), {limit}, Partial", plan), name
    assert "TakeOrderedAndProject(limit=10" in planned(
        registered.queries()["top10_category"](spark, SF))


def test_page_order_without_hot_sessions_is_one_window(spark):
    plan = executed(registered.queries()["page_pair_counts"](spark, SF))
    assert plan.count("FileScan") == 1 and plan.count("+- Window") == 1


def test_uses_of_the_sliced_window_share_one_shuffle(spark):
    acts = hot_actions(spark).withColumn("ts", F.timestamp_seconds(F.col("order_category_ids").cast("long")))
    acts = acts.withColumn("id", F.col("order_category_ids").cast("long"))
    pairs = successor_pairs(acts, "session_id", "click_category_id", ["ts", "id"], "ts", hot_rows=10_000)
    plan = executed(pairs.groupBy("next_value").count())
    assert plan.count("ReusedExchange") >= 2 and pairs.count() == 60_000 - acts.select("session_id").distinct().count()


def test_quota_and_sample_share_the_session_rollup(spark):
    kept = registered._kept(spark, f"{TESTDATA}/sf0.01")
    sample = sampling.sample_sessions(kept, 900, "x")
    assert "ReusedExchange" in executed(sample)


def hot_actions(spark, n=60_000):
    """A third of all rows belongs to one session."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), i % 5000)).alias("session_id"),
        (i % 7).alias("click_category_id"),
        i.alias("order_category_ids").cast("string"),
        F.lit(None).cast("string").alias("pay_category_ids"),
        F.sha2(i.cast("string"), 512).alias("filler"),
    )


def test_hot_session_is_split_in_the_filter(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    acts = hot_actions(spark).repartition(8).persist()
    kept = acts.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).where("n > 8")
    counted = sessions.filtered_actions(acts, kept).agg(F.count("filler"))
    assert "SortMergeJoin(skew=true)" in executed(counted)
    assert counted.first()[0] == acts.join(kept, "session_id").count()
    without = joins.rows_without(acts, kept, "session_id").agg(F.count("filler"))
    assert "SortMergeJoin(skew=true)" in executed(without)
    assert without.first()[0] == acts.count() - counted.first()[0]
    acts.unpersist()


def test_anti_join_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k bigint, v string")
    listed = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert rows_of(joins.rows_without(rows, listed, "k"), "v") == [("b",), ("c",)]
    assert rows_of(joins.rows_with(rows, listed, "k"), "v") == [("a",)]


def test_hot_category_and_session_are_combined_before_the_shuffle(spark):
    top = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    acts = hot_actions(spark)
    for frame in (categories.category_full_counts(acts),
                  categories.category_session_clicks(acts, top)):
        assert "partial_count" in planned(frame)


def test_users_are_not_forced_into_a_broadcast(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    kept = registered._kept(spark, SF)
    assert "BroadcastHashJoin" not in executed(kept)
    top = retail.products(spark, SF)
    assert "BroadcastExchange" not in planned(top)
