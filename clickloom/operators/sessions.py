"""Sessions: roll-up of actions, user attributes, filters, visit and step shares."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.numbers import share
from clickloom.functions.texts import distinct_list, is_not_empty
from clickloom.functions.times import format_time
from clickloom.operators.joins import rows_with
from clickloom.sources.tables import NO_CLICK, with_action_ts

# Buckets of the session report, both ends included, None for open.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)


@dataclass(frozen=True)
class SessionFilter:
    """Conditions on sessions. None and empty text both mean "no condition".

    Lists are sequences or comma-separated text. An age condition needs both ends.
    """

    start_age: int | str | None = None
    end_age: int | str | None = None
    professionals: str | Iterable[str] | None = None
    cities: str | Iterable[str] | None = None
    sex: str | None = None
    keywords: str | Iterable[str] | None = None
    category_ids: str | Iterable[int | str] | None = None

    @classmethod
    def from_params(cls, params: Mapping[str, object]) -> SessionFilter:
        """From a task parameter object with camel-case keys; other keys are ignored."""
        def camel(name: str) -> str:
            head, *tail = name.split("_")
            return head + "".join(word.capitalize() for word in tail)

        return cls(**{f.name: params.get(camel(f.name)) for f in fields(cls)})

    def on_user(self) -> list[Column]:
        """Conditions on the columns of the user table."""
        found: list[Column] = []
        if _given(self.start_age) and _given(self.end_age):
            found.append(F.col("age").between(int(self.start_age), int(self.end_age)))
        if _given(self.professionals):
            found.append(F.col("professional").isin(_items(self.professionals)))
        if _given(self.cities):
            found.append(F.col("city").isin(_items(self.cities)))
        if _given(self.sex):
            found.append(F.col("sex") == self.sex)
        return found

    def on_actions(self) -> dict[str, Column]:
        """Conditions that one action of the session has to meet, by name."""
        found: dict[str, Column] = {}
        if _given(self.keywords):
            # A search of several words, set apart by commas, hits by any of them.
            searched = F.split("search_keyword", ",")
            wanted = F.array(*[F.lit(k) for k in _items(self.keywords)])
            found["_keyword_hit"] = (
                is_not_empty(F.col("search_keyword")) & F.arrays_overlap(searched, wanted)
            )
        if _given(self.category_ids):
            category = F.col("click_category_id")
            wanted = [int(i) for i in _items(self.category_ids)]
            found["_category_hit"] = (category != NO_CLICK) & category.isin(wanted)
        return found


def _given(value: object) -> bool:
    return value is not None and value != "" and value != [] and value != ()


def _items(value: str | Iterable) -> list[str]:
    if isinstance(value, str):
        return value.rstrip(",").split(",")
    return [str(v) for v in value]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _session_basics(actions: DataFrame) -> dict[str, Column]:
    """Aggregates with a fixed-size buffer: these run as one hash aggregation."""
    return {
        "user_id": F.coalesce(
            F.min(F.when(F.col("user_id") != -1, F.col("user_id"))), F.lit(-1).cast("bigint")
        ),
        "start_ts": F.min("action_ts"),
        "end_ts": F.max("action_ts"),
        "step_length": F.count(F.lit(1)),
    }


def _visit_length() -> Column:
    return F.unix_seconds("end_ts") - F.unix_seconds("start_ts")


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session with the keywords searched and the categories clicked."""
    typed = with_action_ts(actions)
    keyword = F.when(is_not_empty(F.col("search_keyword")), F.col("search_keyword"))
    category = F.when(F.col("click_category_id") != NO_CLICK, F.col("click_category_id"))
    # First one row for each keyword and category of a session, with buffers of fixed size; the lists
    # are then made of these rows, however many actions there are.
    parts = typed.groupBy("session_id", keyword.alias("_keyword"), category.alias("_category")).agg(
        *[c.alias(name) for name, c in _session_basics(typed).items()]
    )
    known = F.when(F.col("user_id") != -1, F.col("user_id"))
    rolled = parts.groupBy("session_id").agg(
        F.coalesce(F.min(known), F.lit(-1).cast("bigint")).alias("user_id"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("step_length").alias("step_length"),
        distinct_list(F.col("_keyword")).alias("search_keywords"),
        distinct_list(F.col("_category")).alias("click_category_ids"),
    )
    return rolled.select(
        "session_id", "user_id", "search_keywords", "click_category_ids",
        _visit_length().alias("visit_length"), "step_length",
        format_time("start_ts").alias("start_time"),
    )


def session_full_info(rollup: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's attributes. Sessions without a user drop out."""
    return rollup.join(users.select("user_id", "age", "professional", "sex", "city"), "user_id")


def kept_sessions(
    actions: DataFrame, users: DataFrame, conditions: SessionFilter = SessionFilter()
) -> DataFrame:
    """Sessions that have a user and meet the conditions.

    Keyword and category conditions are flags inside the roll-up, not sets of values, so the
    aggregation keeps a fixed-size buffer per session. User conditions run below the join.
    """
    typed = with_action_ts(actions)
    flags = conditions.on_actions()
    rolled = typed.groupBy("session_id").agg(
        *[c.alias(name) for name, c in _session_basics(typed).items()],
        *[F.bool_or(c).alias(name) for name, c in flags.items()],
    )
    hits = rolled.where(_all([F.col(name) for name in flags]))
    wanted = users.where(_all(conditions.on_user()))
    return hits.join(wanted.select("user_id"), "user_id").select(
        "session_id", "user_id", "start_ts", _visit_length().alias("visit_length"), "step_length"
    )


def filter_sessions(full_info: DataFrame, conditions: SessionFilter) -> DataFrame:
    """The same conditions on full session rows, as `session_full_info` gives them."""
    checks = conditions.on_user()
    for column, wanted in (
        ("search_keywords", conditions.keywords),
        ("click_category_ids", conditions.category_ids),
    ):
        if _given(wanted):
            values = F.array(*[F.lit(v) for v in _items(wanted)])
            checks.append(F.arrays_overlap(F.split(column, ","), values))
    return full_info.where(_all(checks))


def filtered_actions(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """Actions of the kept sessions."""
    return rows_with(actions, kept, "session_id")


def _in_bucket(value: Column, low: int, high: int | None) -> Column:
    return value >= low if high is None else value.between(low, high)


def session_stat_ratio(sessions: DataFrame, task_id: str) -> DataFrame:
    """Number of sessions and the share of each visit-length and step-length bucket.

    One row, also for no sessions: then the number and all shares are 0.
    """
    return _shares(sessions.agg(*_bucket_counts()), task_id)


def observed(sessions: DataFrame, observation: Observation) -> DataFrame:
    """The sessions as they are; computing them once counts them and their buckets on the way.

    `session_stat_of` makes the report of these counts, without another pass. Compute the frame in one
    action; a second one doesn't change the counts.
    """
    return sessions.observe(observation, *_bucket_counts())


def session_stat_of(
    spark: SparkSession, observation: Observation, task_id: str
) -> DataFrame:
    """`session_stat_ratio` of the sessions that were observed; waits until they are computed."""
    counts = observation.get
    schema = ", ".join(f"{name} bigint" for name in counts)
    return _shares(spark.createDataFrame([tuple(counts.values())], schema), task_id)


def _bucket_counts() -> list[Column]:
    """The number of sessions, and of those in each bucket."""
    counts = [F.count(F.lit(1)).alias("session_count")]
    for prefix, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS)):
        for name, low, high in buckets:
            inside = F.count_if(_in_bucket(F.col(prefix), low, high))
            counts.append(inside.alias(f"{prefix}_{name}_ratio"))
    return counts


def _shares(counted: DataFrame, task_id: str) -> DataFrame:
    number, *buckets = counted.columns
    return counted.select(
        F.lit(task_id).alias("taskid"),
        number,
        *[F.coalesce(share(F.col(b), F.col(number)), F.lit(0.0)).alias(b) for b in buckets],
    )
