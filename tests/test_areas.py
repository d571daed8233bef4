from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.operators import areas
from clickloom.sources.cities import CITIES, area_level, city_dimension
from clickloom.sources.tables import clicks, clicks_between


def clicked(actions, *city_and_product):
    return actions(*[{"city_id": c, "click_product_id": p} for c, p in city_and_product])


def test_counts_and_city_lists(spark, actions):
    acts = clicked(actions, (1, 5), (1, 5), (2, 5), (0, 5), (99, 5), (1, -1), (1, 6))
    counts = areas.area_product_counts(clicks(acts), city_dimension(spark))
    assert rows_of(counts, "area", "pid", "click_count", "city_infos") == sorted([
        ("华东", 5, 3, "1:上海,2:南京"), ("华东", 6, 1, "1:上海"), ("华北", 5, 1, "0:北京")], key=repr)


def test_counting_before_the_city_join_changes_nothing(spark, actions):
    acts = clicked(actions, *[(i % 11, i % 4) for i in range(200)])
    early = areas.area_product_counts(clicks(acts), city_dimension(spark))
    late = areas.area_clicks(clicks(acts), city_dimension(spark)).groupBy("area", "pid").count()
    assert rows_of(early, "area", "pid", "click_count") == rows_of(late)


def test_status_and_unknown_products(spark, actions):
    acts = clicked(actions, (0, 1), (0, 2), (0, 3), (0, 4), (0, 5))
    products = spark.createDataFrame([
        (1, "a", '{"product_status": 0}'), (2, "b", '{"product_status": 1}'),
        (3, "c", "{}"), (4, "d", "no json"),
    ], "product_id bigint, product_name string, extend_info string")
    info = areas.area_product_info(
        areas.area_product_counts(clicks(acts), city_dimension(spark)), products)
    assert rows_of(info, "pid", "product_status") == [
        (1, "Self"), (2, "Third Party"), (3, "Third Party"), (4, "Third Party")
    ]


def test_top_three_with_ties_and_levels(spark):
    info = spark.createDataFrame(
        [("华北", "x", p, f"n{p}", "Self", c) for p, c in [(1, 5), (2, 9), (3, 5), (4, 5)]],
        "area string, city_infos string, pid bigint, product_name string, "
        "product_status string, click_count bigint")
    top = areas.area_top_products(info, "t")
    assert top.columns == ["taskid", "area", "areaLevel", "productid", "cityInfos", "clickCount",
                           "productName", "productStatus"]
    assert rows_of(top, "productid", "clickCount", "areaLevel") == [
        (1, 5, "A_Level"), (2, 9, "A_Level"), (3, 5, "A_Level")
    ]


@pytest.mark.parametrize("area, level", [
    ("华北", "A_Level"), ("华东", "A_Level"), ("华中", "B_Level"), ("华南", "B_Level"),
    ("西南", "C_Level"), ("西北", "C_Level"), ("东北", "D_Level"), ("?", "D_Level"),
])
def test_levels(spark, area, level):
    assert spark.range(1).select(area_level(F.lit(area))).first()[0] == level


def test_ten_cities(spark):
    found = city_dimension(spark)
    assert [tuple(r) for r in found.orderBy("city_id").collect()] == list(CITIES)
    assert found.dtypes == [("city_id", "bigint"), ("city_name", "string"), ("area", "string")]


def test_click_scan_keeps_both_ends_of_the_range(actions):
    acts = actions(*[
        {"date": f"2020-05-0{d}", "click_product_id": d} for d in range(1, 6)
    ])
    found = clicks_between(acts, "2020-05-02", "2020-05-04")
    assert rows_of(found, "click_product_id") == [(2,), (3,), (4,)]
