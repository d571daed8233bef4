"""The input tables of the analyses as views over the retail test tables (see FIXTURES.md).

`events` plays the clickstream and the ad feed, `customer` the users, `part` the products,
`nation` and `region` the cities and areas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.folders import hadoop_path
from clickloom.functions.times import TIME_FORMAT
from clickloom.operators.ordered import gap_sessions
from clickloom.session import pin_utc

# Columns of the tables used. With them a read opens no file for its schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}
LEVELS = {"A_Level": ("AFRICA", "AMERICA"), "B_Level": ("ASIA",), "C_Level": ("EUROPE",)}
GAP_SECONDS = 30 * 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(
    spark: SparkSession,
    sf_dir: str,
    start_date: str | None = None,
    end_date: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """Events with a typed time and the number `k`. Dates cut the scan on the stored column.

    As a stream, the table's files are the feed.
    """
    if stream:
        reader = pin_utc(spark).readStream.schema(SCHEMAS["events"])
        fs, path = hadoop_path(spark, f"{sf_dir}/events.parquet")
        if fs.getFileStatus(path).isDirectory():
            rows = reader.parquet(path.toString())
        else:  # a stream reads folders: of this one, the one file
            rows = reader.option("pathGlobFilter", path.getName()).parquet(sf_dir)
    else:
        rows = table(spark, sf_dir, "events")
    if start_date is not None:
        rows = rows.where(F.col("ts") >= F.lit(start_date).cast("date").cast("timestamp_ntz"))
    if end_date is not None:
        after = F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp_ntz")
        rows = rows.where(F.col("ts") < after)
    return rows.select(
        "event_id", "user_id", "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def actions(
    spark: SparkSession,
    sf_dir: str,
    start_date: str | None = None,
    end_date: str | None = None,
    gap: bool = False,
) -> DataFrame:
    """The clickstream. Sessions are days, weeks or months of a user, or, with `gap`, end at
    a pause of half an hour."""
    rows = events(spark, sf_dir, start_date, end_date)
    if gap:
        rows = gap_sessions(rows, "user_id", "ts", GAP_SECONDS)
        session = F.concat_ws("_", "user_id", "session_no")
    else:
        session = F.concat_ws("_", "user_id", _period())

    def only(event_type: str, value: Column) -> Column:
        return F.when(F.col("event_type") == event_type, value)

    category = F.col("k") % 20
    product = F.col("event_id") % 40

    def category_list(shift: int) -> Column:
        return F.concat_ws(",", category.cast("string"), ((F.col("k") + shift) % 20).cast("string"))

    second = F.date_trunc("second", "ts")
    return rows.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        session.alias("session_id"),
        (F.col("k") % 10).cast("bigint").alias("page_id"),
        F.date_format(second, TIME_FORMAT).alias("action_time"),
        only("signup", F.concat(F.lit("kw"), F.col("k") % 10)).alias("search_keyword"),
        F.coalesce(only("click", category), F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.coalesce(only("click", product), F.lit(-1)).cast("bigint").alias("click_product_id"),
        only("view", category_list(7)).alias("order_category_ids"),
        only("view", product.cast("string")).alias("order_product_ids"),
        only("purchase", category_list(3)).alias("pay_category_ids"),
        only("purchase", product.cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
        second.alias("action_ts"),
        "event_id",
    )


def _period() -> Column:
    kind = F.col("user_id") % 3
    return (
        F.when(kind == 0, F.date_format("ts", "yyyyMMdd"))
        .when(kind == 1, F.concat(F.lit("w"), F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")))
        .otherwise(F.date_format("ts", "yyyyMM"))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (F.col("p_size") % 2).cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), status, F.lit("}")).alias("extend_info"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nations = table(spark, sf_dir, "nation")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_lines(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """One feed line per event: the text and its time."""
    rows = events(spark, sf_dir, stream=stream).withColumn("city", F.col("user_id") % 25)
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("city"), "n_regionkey"
    )
    return rows.join(nations, "city").select(
        "ts",
        F.concat_ws(
            " ", F.unix_millis("ts"), "n_regionkey", "city", "user_id", F.col("k") % 20
        ).alias("value"),
    )
