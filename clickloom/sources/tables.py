"""Batch tables: schemas and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import parse_time

# Columns of the input tables. -1 in a click id means "no click";
# a null search, order or pay column means "none".
ACTION_SCHEMA = """
    date string, user_id bigint, session_id string, page_id bigint, action_time string,
    search_keyword string, click_category_id bigint, click_product_id bigint,
    order_category_ids string, order_product_ids string,
    pay_category_ids string, pay_product_ids string, city_id bigint
"""
USER_SCHEMA = """
    user_id bigint, username string, name string, age int,
    professional string, city string, sex string
"""
PRODUCT_SCHEMA = "product_id bigint, product_name string, extend_info string"

NO_CLICK = -1


def read_table(
    spark: SparkSession, source: str, fmt: str | None = "parquet", schema: str | None = None
) -> DataFrame:
    """Read files at `source`, or the catalog table of that name when `fmt` is None."""
    if fmt is None:
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def read_actions(spark: SparkSession, source: str, fmt: str | None = "parquet") -> DataFrame:
    return read_table(spark, source, fmt, ACTION_SCHEMA)


def read_users(spark: SparkSession, source: str, fmt: str | None = "parquet") -> DataFrame:
    return read_table(spark, source, fmt, USER_SCHEMA)


def read_products(spark: SparkSession, source: str, fmt: str | None = "parquet") -> DataFrame:
    return read_table(spark, source, fmt, PRODUCT_SCHEMA)


def actions_between(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Actions from `start_date` to `end_date`, both `yyyy-MM-dd` and both included."""
    return actions.where(F.col("date").between(start_date, end_date))


def clicks_between(actions: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """City and product of each click in a date range; other columns are not read."""
    return clicks(actions_between(actions, start_date, end_date))


def clicks(actions: DataFrame) -> DataFrame:
    return actions.where(F.col("click_product_id") != NO_CLICK).select("city_id", "click_product_id")


def with_action_ts(actions: DataFrame) -> DataFrame:
    """Add the typed action time once, unless the table brings it along."""
    if "action_ts" in actions.columns:
        return actions
    return actions.withColumn("action_ts", parse_time("action_time"))
