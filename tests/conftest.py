from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from clickloom.sources.tables import ACTION_SCHEMA

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_DEFAULTS = {
    "date": "2020-05-01", "user_id": 1, "session_id": "s", "page_id": 0,
    "action_time": "2020-05-01 10:00:00", "search_keyword": None,
    "click_category_id": -1, "click_product_id": -1,
    "order_category_ids": None, "order_product_ids": None,
    "pay_category_ids": None, "pay_product_ids": None, "city_id": 0,
}


@pytest.fixture
def actions(spark):
    """Builds the action table from rows that give only what matters."""
    def build(*rows: dict):
        full = [tuple({**_DEFAULTS, **row}[c] for c in _DEFAULTS) for row in rows]
        return spark.createDataFrame(full, ACTION_SCHEMA)
    return build


@pytest.fixture
def users(spark):
    def build(*rows: tuple):
        """Rows of user_id, age, professional, city, sex."""
        full = [(u, f"user{u}", f"name{u}", age, job, city, sex) for u, age, job, city, sex in rows]
        return spark.createDataFrame(
            full, "user_id bigint, username string, name string, age int, "
                  "professional string, city string, sex string")
    return build


def rows_of(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
