"""The SQL functions give what the column functions give, and stay in the JVM."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.functions import sql, texts, times
from clickloom.operators import areas
from clickloom.plans import reports
from clickloom.sources.cities import area_level, city_dimension

RECORDS = [
    "page=1|keyword=a", "keyword=|page=2", "page=1|page=2", "a=b=c|keyword=x", "keyword=x==", "keyword", "",
    None, "xkeyword=1|keyword=2", "keyword=a|keyword=b|page=3", "page=|", "=|=", "keyword=k.1|page=1",
]


@pytest.mark.parametrize("delimiter", ["|", ".", "||"])
def test_packed_fields(spark, delimiter):
    sql.register(spark)
    rows = spark.createDataFrame(
        [(i, r and r.replace("|", delimiter)) for i, r in enumerate(RECORDS)], "i int, record string")
    rows.createOrReplaceTempView("records")
    got = spark.sql(
        "SELECT i, packed_field(record, :d, 'keyword') AS a, set_packed_field(record, :d, 'page', 'n') AS b "
        "FROM records", args={"d": delimiter})
    record = F.col("record")
    want = rows.select(
        "i", texts.packed_field(record, delimiter, "keyword").alias("a"),
        texts.set_packed_field(record, delimiter, "page", "n").alias("b"))
    assert rows_of(got) == rows_of(want)


def test_plain_functions(spark):
    sql.register(spark)
    values = [None, "", ",", ",a,,b,", "1", "12", "123", " x ", '{"a": 1}', '{"a": {"b": "c"}}', "{bad"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    rows.createOrReplaceTempView("given")
    v = F.col("v")
    want = rows.select(
        "v", texts.is_empty(v).alias("a"), texts.is_not_empty(v).alias("b"), texts.trim_comma(v).alias("c"),
        texts.two_digits(v).alias("d"), texts.json_field(v, "a").alias("e"),
        texts.id_and_name(F.length(v), v, "-").alias("f"), areas.product_status(v).alias("g"),
        area_level(v).alias("h"))
    got = spark.sql("""
        SELECT v, is_empty(v) AS a, is_not_empty(v) AS b, trim_comma(v) AS c, two_digits(v) AS d,
               json_field(v, 'a') AS e, id_and_name(length(v), v, '-') AS f, product_status(v) AS g,
               area_level(v) AS h
        FROM given""")
    assert rows_of(got) == rows_of(want)


def test_lists_and_times(spark):
    sql.register(spark)
    rows = spark.createDataFrame(
        [(1, "b", "2020-01-02 03:04:05"), (1, "a", None), (1, "b", None), (2, None, None)], "k int, v string, t string")
    rows = rows.withColumn("t", F.to_timestamp("t"))
    rows.createOrReplaceTempView("listed")
    got = spark.sql("SELECT k, distinct_list(collect_set(v)) AS v FROM listed GROUP BY k")
    assert rows_of(got) == rows_of(rows.groupBy("k").agg(texts.distinct_list("v").alias("v")))
    keys = spark.sql("SELECT date_key(t), minute_key(t) FROM listed")
    assert rows_of(keys) == rows_of(rows.select(times.date_key("t"), times.minute_key("t")))


def test_area_levels_are_escaped(spark):
    sql.register(spark, {"it's": ("a'b", "c\\d")})
    got = spark.sql(r"SELECT area_level('a\'b'), area_level('c\\d'), area_level('x')").first()
    assert tuple(got) == ("it's", "it's", "D_Level")
    sql.register(spark)


def test_area_report_as_text(spark, actions):
    rows = actions(*[
        {"click_product_id": p, "city_id": c, "session_id": str(n)}
        for n, (p, c) in enumerate([(1, 0), (1, 0), (2, 0), (2, 1), (3, 1), (9, 1), (1, 77), (-1, 0)])
    ])
    products = spark.createDataFrame(
        [(i, f"p{i}", '{"product_status": %d}' % (i % 2)) for i in (1, 2, 3)],
        "product_id bigint, product_name string, extend_info string")
    sql.register(spark)
    views = {"actions": rows, "cities": city_dimension(spark), "products": products}
    got = reports.run(spark, reports.AREA_TOP_PRODUCTS, views, taskid="t", top=3)
    clicks = rows.where("click_product_id <> -1")
    info = areas.area_product_info(areas.area_product_counts(clicks, city_dimension(spark)), products)
    assert rows_of(got) == rows_of(areas.area_top_products(info, "t"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
