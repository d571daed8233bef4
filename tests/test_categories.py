from __future__ import annotations

from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.operators import categories


def test_every_kind_of_touch_counts(actions):
    acts = actions(
        {"click_category_id": 1, "order_category_ids": "2,3", "pay_category_ids": "4"},
        {"order_category_ids": "2,2,x"},
        {"pay_category_ids": "1"},
        {"search_keyword": "tea"},
        {"order_category_ids": ""},
    )
    assert rows_of(categories.category_full_counts(acts)) == [
        (1, 1, 0, 1), (2, 0, 3, 0), (3, 0, 1, 0), (4, 0, 0, 1)
    ]
    assert rows_of(categories.category_event_counts(acts)) == [
        (1, "click", 1), (1, "pay", 1), (2, "order", 3), (3, "order", 1), (4, "pay", 1)
    ]


def test_one_pass_equals_three_left_joins(actions):
    acts = actions(*[
        {"click_category_id": i % 5 if i % 3 else -1,
         "order_category_ids": f"{i % 7},{i % 4}" if i % 2 else None,
         "pay_category_ids": str(i % 9) if i % 4 == 0 else None}
        for i in range(60)
    ])
    long = categories.category_event_counts(acts)
    joined = long.select("category_id").distinct()
    for kind in ("click", "order", "pay"):
        side = long.where(F.col("kind") == kind).select(
            "category_id", F.col("event_count").alias(f"{kind}_count"))
        joined = joined.join(side, "category_id", "left")
    assert rows_of(joined.fillna(0)) == rows_of(categories.category_full_counts(acts))


def test_top_categories_order_and_ties(spark):
    counts = spark.createDataFrame(
        [(1, 5, 1, 1), (2, 5, 2, 0), (3, 5, 1, 1), (4, 5, 1, 2), (5, 2**40, 0, 0), (6, 0, 9, 9)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    top = [r.category_id for r in categories.top_categories(counts, 5).collect()]
    assert top == [5, 2, 4, 1, 3]


def test_top_sessions_per_category(spark, actions):
    acts = actions(
        *[{"session_id": f"s{i:02d}", "click_category_id": 1} for i in range(12)],
        *[{"session_id": "s11", "click_category_id": 1}] * 3,
        {"session_id": "s00", "click_category_id": 2},
        {"session_id": "s01", "click_category_id": 7},
        {"session_id": "s05", "order_category_ids": "2"},
    )
    top = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    clicks = categories.category_session_clicks(acts, top)
    best = categories.top_sessions(clicks)
    assert rows_of(best) == sorted(
        [(1, "s11", 4), *[(1, f"s{i:02d}", 1) for i in range(9)], (2, "s00", 1)], key=repr)
    kept = spark.createDataFrame([("s00",), ("s11",)], "session_id string")
    assert rows_of(categories.category_session_clicks(acts, top, kept)) == [
        (1, "s00", 1), (1, "s11", 4), (2, "s00", 1)
    ]
    report = categories.top_session_report(best, "t")
    assert report.columns == ["taskid", "categoryid", "sessionid", "clickCount"]
