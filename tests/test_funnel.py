from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.operators import funnel
from clickloom.operators.ordered import gap_sessions, successor_pairs


def visits(actions, *pages_by_session):
    rows = []
    for s, pages in enumerate(pages_by_session):
        for i, page in enumerate(pages):
            rows.append({"session_id": f"s{s}", "page_id": page,
                         "action_time": f"2020-05-01 {9 + i // 2}:{10 + i}:00"})
    return actions(*rows)


def rates(frame):
    return [tuple(r)[1:] for r in frame.orderBy("pos").collect()]


def test_rates_follow_the_flow(actions):
    acts = visits(actions, [1, 2, 3, 1, 2], [2, 3, 1], [1, 3])
    found = funnel.page_convert_rates(acts, "1,2,3,4,5")
    assert rates(found) == [
        ("1_2", 2, 4, 0.5), ("2_3", 2, 2, 1.0), ("3_4", 0, 2, 0.0), ("4_5", 0, 0, None)
    ]
    packed = funnel.page_split_convert_rate(found, "t").first()
    assert tuple(packed) == ("t", "1_2=0.5|2_3=1.0|3_4=0.0|4_5=")


def test_repeated_pair_keeps_both_places(actions):
    acts = visits(actions, [1, 2, 1, 2])
    assert rates(funnel.page_convert_rates(acts, "1,2,1,2")) == [
        ("1_2", 2, 2, 1.0), ("2_1", 1, 2, 0.5), ("1_2", 2, 1, 2.0)
    ]


def test_flow_of_one_page_has_no_steps(actions):
    acts = visits(actions, [1, 2])
    found = funnel.page_convert_rates(acts, "1")
    assert rates(found) == []
    assert tuple(funnel.page_split_convert_rate(found, "t").first()) == ("t", "")


def test_pages_that_are_no_step_of_the_flow(actions):
    acts = visits(actions, [1, 3, 2, 1])
    assert rows_of(funnel.page_pair_counts(acts, "1,2,3")) == []


def test_start_page_views(actions):
    assert funnel.start_page_views(visits(actions, [5, 5, 1], [5]), "5,1").first()[0] == 3


@pytest.mark.parametrize("seconds, hot_rows", [
    (1, 0), (60, 0), (3600, 0), (86400 * 365, 0), (1, 50), (1, 100_000),
])
def test_slices_do_not_change_pairs(spark, seconds, hot_rows):
    rng = random.Random(7)
    hot = [("hot", rng.randrange(4), rng.randrange(20000), i) for i in range(400)]
    rest = [(f"g{i % 40}", rng.randrange(4), rng.randrange(20000), 1000 + i) for i in range(400)]
    rows = hot + rest
    frame = spark.createDataFrame(rows, "g string, page int, at int, id int").select(
        "g", "page", F.timestamp_seconds("at").alias("ts"), "id")
    want = Counter()
    groups = {}
    for g, page, at, i in rows:
        groups.setdefault(g, []).append((at, i, page))
    for members in groups.values():
        pages = [m[2] for m in sorted(members)]
        want.update(zip(pages, pages[1:]))
    got = successor_pairs(frame, "g", "page", ["ts", "id"], "ts", seconds, hot_rows=hot_rows)
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("seconds, hot_rows", [(1, 0), (100, 0), (299, 0), (1, 50), (1, 100_000)])
def test_slices_do_not_change_gap_sessions(spark, seconds, hot_rows):
    rng = random.Random(11)
    rows = [("hot" if i % 2 else f"g{i % 30}", rng.randrange(90000), i) for i in range(600)]
    timeless = [(g, None, 600 + i) for i, g in enumerate(["hot", "hot", "g2", "g2", "none", "none"])]
    frame = spark.createDataFrame(rows + timeless, "g string, at int, id int").select(
        "g", F.timestamp_seconds("at").alias("ts"), "id")
    want = {}
    groups = {}
    for g, at, i in rows + timeless:
        groups.setdefault(g, []).append((-1_000 if at is None else at, i))
    for members in groups.values():
        number, last = 0, None
        for at, i in sorted(members):
            number += last is None or at - last >= 300
            want[i], last = number, at
    got = gap_sessions(frame, "g", "ts", 300, seconds, hot_rows=hot_rows)
    assert {r.id: r.session_no for r in got.collect()} == want
    assert set(got.columns) == {"g", "ts", "id", "session_no"}
