"""The batch jobs: one call gives all result tables of a job, one call writes them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickloom.operators import areas, categories, funnel, sampling, sessions
from clickloom.sinks.tables import append
from clickloom.sources.cities import AREA_LEVELS
from clickloom.sources.tables import actions_between, clicks_between, with_action_ts

Results = dict[str, DataFrame]


@dataclass(frozen=True)
class SessionJob:
    """Session shares, session sample, top categories and their most active sessions.

    `kept`, one row per session, and `top`, one row per top category, feed several results.
    `persist` keeps them for the writes; parts lost with an executor are computed again.
    """

    kept: DataFrame
    top: DataFrame
    results: Results

    def persist(self) -> SessionJob:
        self.kept.persist()
        self.top.persist()
        return self

    def unpersist(self) -> None:
        self.kept.unpersist()
        self.top.unpersist()


def session_job(
    actions: DataFrame,
    users: DataFrame,
    task_id: str,
    start_date: str,
    end_date: str,
    conditions: sessions.SessionFilter = sessions.SessionFilter(),
    sample_total: int = 100,
    seed: str = "",
    n: int = 10,
) -> SessionJob:
    scope = with_action_ts(actions_between(actions, start_date, end_date))
    kept = sessions.kept_sessions(scope, users, conditions)
    counts = categories.category_full_counts(sessions.filtered_actions(scope, kept))
    top = categories.top_categories(counts, n)
    active = categories.top_sessions(categories.category_session_clicks(scope, top, kept), n)
    return SessionJob(kept, top, {
        "session_stat_ratio": sessions.session_stat_ratio(kept, task_id),
        "session_extract": sampling.session_extract(scope, kept, task_id, sample_total, seed),
        "top10_category": categories.top_category_report(top, task_id),
        "top10_session": categories.top_session_report(active, task_id),
    })


def page_job(
    actions: DataFrame,
    task_id: str,
    start_date: str,
    end_date: str,
    flow: funnel.Flow,
    tie_breakers: Sequence[str] = ("page_id",),
) -> Results:
    scope = actions_between(actions, start_date, end_date)
    rates = funnel.page_convert_rates(scope, flow, tie_breakers)
    return {"page_split_convert_rate": funnel.page_split_convert_rate(rates, task_id)}


def area_job(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    task_id: str,
    start_date: str,
    end_date: str,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    n: int = 3,
) -> Results:
    counts = areas.area_product_counts(clicks_between(actions, start_date, end_date), cities)
    info = areas.area_product_info(counts, products)
    return {"area_top3_product": areas.area_top_products(info, task_id, levels, n)}


def write_results(results: Results, target: str, fmt: str = "parquet", **options: str) -> None:
    """Append each result to its table: a folder below `target`, or, with fmt="jdbc", the
    database table of its name (`target` is then the connection url)."""
    for name, frame in results.items():
        if fmt == "jdbc":
            append(frame, name, fmt, url=target, **options)
        else:
            append(frame, f"{target}/{name}", fmt, **options)
