from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clickloom.operators import sampling, sessions
from clickloom.operators.sessions import SessionFilter

VISITS = {
    0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 6: "4s_6s", 7: "7s_9s", 9: "7s_9s",
    10: "10s_30s", 30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m", 180: "1m_3m",
    181: "3m_10m", 600: "3m_10m", 601: "10m_30m", 1800: "10m_30m", 1801: "30m",
}
STEPS = {
    1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30", 30: "10_30",
    31: "30_60", 60: "30_60", 61: "60",
}


def kept_frame(spark, rows):
    return spark.createDataFrame(rows, "session_id string, visit_length bigint, step_length bigint")


@pytest.mark.parametrize("kind, edges", [("visit_length", VISITS), ("step_length", STEPS)])
def test_every_bucket_edge(spark, kind, edges):
    for value, bucket in edges.items():
        pair = (value, 0) if kind == "visit_length" else (0, value)
        row = sessions.session_stat_ratio(kept_frame(spark, [("s", *pair)]), "t").first().asDict()
        hit = [k for k, v in row.items() if k.startswith(kind) and v == 1.0]
        assert hit == ([f"{kind}_{bucket}_ratio"] if bucket else []), value


def test_ratio_columns_in_order_and_empty_input(spark):
    empty = sessions.session_stat_ratio(kept_frame(spark, []), "t")
    names = ["taskid", "session_count"]
    names += [f"visit_length_{n}_ratio" for n, _, _ in sessions.VISIT_BUCKETS]
    names += [f"step_length_{n}_ratio" for n, _, _ in sessions.STEP_BUCKETS]
    assert empty.columns == names
    assert tuple(empty.first()) == ("t", 0, *[0.0] * 15)


def test_rollup_takes_true_ends_and_whole_values(spark, actions):
    rolled = sessions.session_rollup(actions(
        {"action_time": "2020-05-01 9:59:59", "search_keyword": "ab"},
        {"action_time": "2020-05-01 10:00:10", "search_keyword": "a"},
        {"action_time": "2020-05-01 10:00:04", "click_category_id": 12},
        {"action_time": "2020-05-01 10:00:04", "click_category_id": 1},
        {"action_time": "2020-05-01 10:00:05", "click_category_id": 1, "search_keyword": ""},
    ))
    assert rows_of(rolled) == [
        ("s", 1, "a,ab", "1,12", 11, 5, "2020-05-01 09:59:59")
    ]


def test_rollup_without_keywords_or_clicks(spark, actions):
    row = sessions.session_rollup(actions({})).first()
    assert (row.search_keywords, row.click_category_ids, row.visit_length) == (None, None, 0)


PEOPLE = [
    (1, 20, "clerk", "Rome", "male"),
    (2, 50, "smith", "Oslo", "female"),
    (3, 51, "smith", "Rome", "male"),
    (4, None, None, None, None),
]


@pytest.fixture
def scene(actions, users):
    rows = [
        {"session_id": f"s{u}", "user_id": u, "search_keyword": word, "click_category_id": category}
        for u, word, category in [
            (1, "tea", 1), (2, "teapot", 12), (3, None, -1), (4, "tea", 2), (9, "tea", 1)
        ]
    ]
    return actions(*rows), users(*PEOPLE)


@pytest.mark.parametrize("conditions, kept", [
    ({}, "1234"),
    ({"start_age": 20, "end_age": 50}, "12"),
    ({"start_age": 21, "end_age": ""}, "1234"),
    ({"end_age": 20}, "1234"),
    ({"professionals": "smith"}, "23"),
    ({"professionals": "smith,clerk", "cities": "Rome"}, "13"),
    ({"sex": "male"}, "13"),
    ({"sex": ""}, "1234"),
    ({"keywords": "tea"}, "14"),
    ({"keywords": ["teapot", "x"]}, "2"),
    ({"category_ids": "1"}, "1"),
    ({"category_ids": [2, 12]}, "24"),
    ({"category_ids": "-1"}, ""),
    ({"keywords": "tea", "category_ids": "2", "sex": "male"}, ""),
])
def test_filters(scene, conditions, kept):
    acts, people = scene
    wanted = SessionFilter(**conditions)
    lean = sessions.kept_sessions(acts, people, wanted)
    full = sessions.filter_sessions(
        sessions.session_full_info(sessions.session_rollup(acts), people), wanted)
    expected = [f"s{u}" for u in kept]
    assert [r[0] for r in rows_of(lean, "session_id")] == expected
    assert [r[0] for r in rows_of(full, "session_id")] == expected
    assert [r[0] for r in rows_of(sessions.filtered_actions(acts, lean), "session_id")] == expected


def test_a_search_of_several_words_hits_by_each_of_them(actions, users):
    acts = actions({"session_id": "s1", "user_id": 1, "search_keyword": "green,tea"})
    people = users(*PEOPLE)
    info = sessions.session_full_info(sessions.session_rollup(acts), people)
    for word, kept in (("tea", 1), ("green", 1), ("green,tea", 1), ("gre", 0)):
        wanted = SessionFilter(keywords=word)
        assert sessions.kept_sessions(acts, people, wanted).count() == kept
        assert sessions.filter_sessions(info, wanted).count() == kept


def test_filter_from_parameters():
    given = SessionFilter.from_params({
        "startDate": "2020-05-01", "startAge": 20, "endAge": 50, "professionals": "",
        "categoryIds": "1,2",
    })
    assert given == SessionFilter(20, 50, "", None, None, None, "1,2")


# --- sample ------------------------------------------------------------------------------------

def sessions_at(spark, counts):
    """`counts` maps 'yyyy-MM-dd HH' to a number of sessions."""
    rows = [(f"{hour}#{i}", f"{hour}:00:00") for hour, n in counts.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "session_id string, at string")
    return frame.select("session_id", F.to_timestamp("at").alias("start_ts"))


def quotas(spark, counts, total):
    found = sampling.hour_quotas(sessions_at(spark, counts), total)
    return {f"{d} {h}": q for d, h, q in rows_of(found, "date", "hour", "quota")}


def test_quota_arithmetic(spark):
    assert quotas(spark, {"2020-05-01 09": 29, "2020-05-01 10": 71}, 100) == {
        "2020-05-01 09": 29, "2020-05-01 10": 71}
    assert quotas(spark, {"2020-05-01 09": 1, "2020-05-01 10": 2}, 1) == {}
    assert quotas(spark, {"2020-05-01 09": 1, "2020-05-01 10": 2}, 2) == {"2020-05-01 10": 1}
    assert quotas(spark, {"2020-05-01 09": 3, "2020-05-02 09": 7}, 100) == {
        "2020-05-01 09": 3, "2020-05-02 09": 7}
    assert quotas(spark, {}, 100) == {}


def test_no_quota_when_days_outnumber_the_sample(spark):
    days = {f"2020-{m:02d}-{d:02d} 00": 1 for m in (1, 3, 5, 7) for d in range(1, 31)}
    assert quotas(spark, days, 100) == {}


def test_sample_is_exact_repeatable_and_without_repeats(spark):
    population = sessions_at(spark, {"2020-05-01 09": 60, "2020-05-01 10": 30, "2020-05-02 01": 200})
    first = rows_of(sampling.sample_sessions(population, 100, "a"), "date", "hour", "session_id")
    again = rows_of(
        sampling.sample_sessions(population.repartition(5), 100, "a"), "date", "hour", "session_id")
    other = rows_of(sampling.sample_sessions(population, 100, "b"), "date", "hour", "session_id")
    assert first == again != other
    assert len({r[2] for r in first}) == len(first) == len(other)
    per_hour = {}
    for date, hour, session in first:
        assert session.startswith(f"{date} {hour}#")
        per_hour[hour] = per_hour.get(hour, 0) + 1
    assert per_hour == {"09": 33, "10": 16, "01": 50}


def test_extract_has_details_of_the_drawn_sessions(spark, actions, users):
    acts = actions(
        {"session_id": "a", "search_keyword": "tea", "click_category_id": 3},
        {"session_id": "b", "action_time": "2020-05-01 10:30:00"},
    )
    kept = sessions.kept_sessions(acts, users(*PEOPLE))
    out = sampling.session_extract(acts, kept, "t", 100)
    assert rows_of(out) == [
        ("t", "a", "2020-05-01 10:00:00", "tea", "3"), ("t", "b", "2020-05-01 10:30:00", None, None)
    ]
    assert out.columns == ["taskid", "sessionid", "startTime", "searchKeywords", "clickCategoryIds"]


@pytest.mark.parametrize("n", [1, 7, 1001, 5000])
def test_ranks_in_parts_equal_plain_ranks(spark, n):
    from clickloom.operators.ranks import RANK, ranked

    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"), "id")
    got = ranked(rows, ["g"], [F.desc("score"), "id"], n, "id")
    order = {}
    for r in sorted(rows.collect(), key=lambda r: (r.g, -r.score, r.id)):
        order.setdefault(r.g, []).append(r.id)
    want = {(g, i, k + 1) for g, ids in order.items() for k, i in enumerate(ids[:n])}
    assert {(r.g, r.id, r[RANK]) for r in got.collect()} == want


def test_large_sample_is_exact(spark):
    population = sessions_at(spark, {"2020-05-01 09": 3000, "2020-05-01 10": 1000})
    drawn = sampling.sample_sessions(population, 2000, "a").groupBy("hour").count()
    assert rows_of(drawn) == [("09", 1500), ("10", 500)]
