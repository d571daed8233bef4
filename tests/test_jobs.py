from __future__ import annotations

import json

import pytest
from conftest import TESTDATA, rows_of

import __spark_entry__ as registered
import run_job
from clickloom.plans import jobs
from clickloom.sinks import tables
from clickloom.sources import retail

SF = f"{TESTDATA}/sf0.01"
MONTH = ("2024-01-01", "2024-01-31")


@pytest.fixture(scope="module")
def clickstream(spark):
    return retail.actions(spark, SF)


def test_session_job_gives_the_four_results(spark, clickstream):
    job = jobs.session_job(
        clickstream, retail.users(spark, SF), "task", *MONTH, registered.BY_AGE, 900, "_7")
    for persisted in (False, True):
        if persisted:
            job.persist()
        for name, frame in job.results.items():
            assert rows_of(frame) == rows_of(registered.queries()[name](spark, SF)), name
    job.unpersist()


def test_page_and_area_jobs(spark, clickstream):
    page = jobs.page_job(clickstream, "task", *MONTH, "1,2,3,4,5,6,7", ("event_id",))
    area = jobs.area_job(clickstream, retail.cities(spark, SF), retail.products(spark, SF), "task",
                         *MONTH, retail.LEVELS)
    for name, frame in {**page, **area}.items():
        assert rows_of(frame) == rows_of(registered.queries()[name](spark, SF)), name


def test_dates_limit_a_job(spark, clickstream):
    none = jobs.session_job(clickstream, retail.users(spark, SF), "t", "2020-01-01", "2020-01-02")
    assert none.results["session_stat_ratio"].first().session_count == 0
    for name in ("session_extract", "top10_category", "top10_session"):
        assert none.results[name].count() == 0


@pytest.fixture(scope="module")
def folders(spark, clickstream, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    clickstream.select(*registered.ACTION_COLUMNS).write.parquet(f"{root}/actions")
    retail.users(spark, SF).write.parquet(f"{root}/users")
    retail.products(spark, SF).write.parquet(f"{root}/products")
    return root


def test_command_line_jobs_append(spark, folders, tmp_path):
    params = json.dumps({
        "startDate": MONTH[0], "endDate": MONTH[1], "startAge": 20, "endAge": 50,
        "professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": "",
        "targetPageFlow": "1,2,3,4,5,6,7",
    })
    common = ["--actions", f"{folders}/actions", "--out", f"{tmp_path}/out", "--params", params]
    users = ["--users", f"{folders}/users"]
    run_job.main(["session", *common, *users, "--task-id", "one"])
    run_job.main(["session", *common, *users, "--task-id", "two"])
    run_job.main(["page", *common])
    run_job.main(["area", *common, "--products", f"{folders}/products"])
    ratio = spark.read.parquet(f"{tmp_path}/out/session_stat_ratio")
    assert rows_of(ratio, "taskid") == [("one",), ("two",)]
    want = registered.queries()["top10_category"](spark, SF).drop("taskid")
    found = spark.read.parquet(f"{tmp_path}/out/top10_category").where("taskid = 'two'")
    assert rows_of(found.drop("taskid")) == rows_of(want)
    assert spark.read.parquet(f"{tmp_path}/out/page_split_convert_rate").count() == 1
    areas = spark.read.parquet(f"{tmp_path}/out/area_top3_product")
    assert {r.areaLevel for r in areas.collect()} == {"A_Level", "B_Level", "C_Level", "D_Level"}


def test_command_line_ad_job(spark, tmp_path):
    spark.createDataFrame([("1588327200000 1 1 5 9",)] * 3, "value string").write.text(
        f"{tmp_path}/feed")
    run_job.main(["ads", "--feed", f"{tmp_path}/feed", "--out", f"{tmp_path}/out",
                  "--checkpoint", f"{tmp_path}/check", "--threshold", "2", "--until-caught-up"])
    from clickloom.streaming.tables import AdTables

    found = AdTables(f"{tmp_path}/out")
    assert rows_of(found.blacklist.read(spark)) == [(5,)]
    assert rows_of(found.top3.read(spark)) == [("20200501", "1", 9, 3)]


def test_jobs_leave_the_state_store_of_a_session(spark):
    """Only the stream with state chooses one, for itself."""
    from clickloom.session import build_session
    from clickloom.streaming.ads import STATE_STORE

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "a.store.of.its.own")
    try:
        assert build_session("tests").conf.get(STATE_STORE) == "a.store.of.its.own"
    finally:
        spark.conf.set(STATE_STORE, before)


def test_catalog_tables(spark, folders):
    frame = spark.read.parquet(f"{folders}/users")
    for _ in range(2):
        tables.replace(frame, "clickloom_users", fmt=None)
    from clickloom.sources.tables import read_users

    assert read_users(spark, "clickloom_users", fmt=None).count() == frame.count()
    spark.sql("DROP TABLE clickloom_users")


def test_database_results_ask_for_the_driver_of_the_url(spark, clickstream):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    page = jobs.page_job(clickstream, "task", *MONTH, "1,2")
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)driver"):
        jobs.write_results(page, "jdbc:nowhere://host/db", "jdbc", user="u", password="p")
