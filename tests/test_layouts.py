"""Stored layouts: what they hold, and what plans on them do without. Counts observed on the way."""

from __future__ import annotations

import os
import random
from uuid import uuid4

import pytest
from conftest import rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from clickloom.operators import sessions
from clickloom.sources import layouts
from clickloom.sources.adlog import file_lines, parse_ad_log
from clickloom.sources.tables import ACTION_SCHEMA, actions_between
from clickloom.streaming import ads as live
from clickloom.streaming.tables import AdTables


def planned(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def week(actions):
    rng = random.Random(2)
    return actions(*[
        {"date": f"2020-05-0{d}", "session_id": f"s{rng.randrange(6)}", "page_id": n, "user_id": n % 3,
         "action_time": f"2020-05-0{d} 10:{rng.randrange(60):02}:00"}
        for d in range(1, 8) for n in range(5)
    ])


def test_by_date_opens_only_the_days_asked_for(spark, tmp_path, week):
    path = f"{tmp_path}/actions"
    layouts.write_by_date(week, path)
    stored = layouts.read_by_date(spark, path, ACTION_SCHEMA)
    some = actions_between(stored, "2020-05-02", "2020-05-03")
    assert rows_of(some, *week.columns) == rows_of(
        actions_between(week, "2020-05-02", "2020-05-03"), *week.columns)
    assert "PartitionFilters: [isnotnull(date" in planned(some)
    assert {f.split("date=")[1][:10] for f in some.inputFiles()} >= {"2020-05-02", "2020-05-03"}
    scan = some._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    some.collect()
    assert scan.metrics().get("numFiles").get().value() == 2


def test_days_of_another_table_prune_the_scan(spark, tmp_path, week):
    path = f"{tmp_path}/actions"
    layouts.write_by_date(week, path)
    stored = layouts.read_by_date(spark, path, ACTION_SCHEMA)
    days = spark.createDataFrame([("2020-05-04", 1), ("2020-05-05", 2)], "date string, kind int")
    some = layouts.days_of(stored, days.where("kind = 1"))
    assert "dynamicpruning" in planned(some)
    assert rows_of(some, "date").count(("2020-05-04",)) == some.count() == 5


def test_only_the_days_written_are_replaced(spark, tmp_path, week):
    path = f"{tmp_path}/actions"
    layouts.write_by_date(week, path)
    kept = os.listdir(f"{path}/date=2020-05-01")
    layouts.write_by_date(week.where("date = '2020-05-02'").limit(2), path)
    stored = layouts.read_by_date(spark, path, ACTION_SCHEMA)
    assert stored.count() == 32 and os.listdir(f"{path}/date=2020-05-01") == kept


def test_sessions_in_buckets_need_no_shuffle(spark, week, users):
    table = f"actions_{uuid4().hex}"
    layouts.write_by_session(week, table, 4)
    try:
        stored = spark.table(table)
        rollup = sessions.session_rollup(stored)
        assert rows_of(rollup) == rows_of(sessions.session_rollup(week))
        assert "Exchange" not in planned(rollup)
        everyone = users(*[(i, 30, "p", "c", "male") for i in range(3)])
        kept = sessions.kept_sessions(stored, everyone)
        some = sessions.filtered_actions(stored, kept.hint("merge"))
        assert rows_of(some, *week.columns) == rows_of(
            sessions.filtered_actions(week, sessions.kept_sessions(week, everyone)), *week.columns)
        assert f"hashpartitioning(session_id" not in planned(sessions.session_rollup(stored))
        assert "SelectedBucketsCount: 4 out of 4" in planned(rollup)
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_observed_counts_make_the_report(spark, week, users):
    kept = sessions.kept_sessions(week, users(*[(i, 30, "p", "c", "male") for i in range(3)]))
    counted = Observation("kept")
    assert sessions.observed(kept, counted).count() == kept.count()
    assert rows_of(sessions.session_stat_of(spark, counted, "t")) == rows_of(
        sessions.session_stat_ratio(kept, "t"))
    none = Observation("none")
    sessions.observed(kept.limit(0), none).collect()
    assert rows_of(sessions.session_stat_of(spark, none, "t")) == rows_of(
        sessions.session_stat_ratio(kept.limit(0), "t"))


LINES = ["1588327200000 1 2 3 4", "x 1 2 3 4", "1588327200000 1 2 y 4", "", "1588327200000 1 2 3", "1 1 1 1 1"]


def test_unreadable_lines_are_counted(spark):
    counted = Observation("feed")
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    assert parse_ad_log(lines, observation=counted).count() == 2
    assert counted.get == {"lines": 6, "unreadable": 4}
    assert parse_ad_log(lines).count() == 2


def test_progress_of_a_stream_tells_of_unreadable_lines(spark, tmp_path):
    folder, tables = f"{tmp_path}/feed", AdTables(f"{tmp_path}/tables")
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    lines.coalesce(1).write.text(folder)
    query = live.start_click_trend(
        file_lines(spark, folder), tables, f"{tmp_path}/checkpoint", available_now=True)
    query.awaitTermination()
    found = [p["observedMetrics"]["feed"] for p in query.recentProgress if p["numInputRows"]]
    assert [(f["lines"], f["unreadable"]) for f in found] == [(6, 4)]
