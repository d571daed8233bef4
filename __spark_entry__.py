"""Registered queries and the SQL they are checked against.

Every query runs over whole tables. Queries about streams run a real stream whose feed is the
whole events table, and return what its sink holds.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from importlib.util import find_spec
from uuid import uuid4

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.folders import remove, scratch_dir
from clickloom.functions import numbers, sql, texts, times
from clickloom.operators import ads, areas, categories, funnel, sampling, sessions
from clickloom.operators.ordered import successor_pairs
from clickloom.plans import reports
from clickloom.session import pin_utc
from clickloom.sinks import keyed
from clickloom.sinks import tables as plain
from clickloom.sources import layouts, retail
from clickloom.sources.adlog import parse_ad_log
from clickloom.sources.cities import city_dimension
from clickloom.sources.tables import ACTION_SCHEMA, actions_between, clicks
from clickloom.streaming import ads as live
from clickloom.streaming.tables import TOP3, AdTables
from oracle.statements import STATEMENTS

# Both are optional; where they are there, an import that fails in them is an error.
if find_spec("clickloom.llm") and find_spec("corpus_pipeline"):
    import corpus_pipeline
    from clickloom.llm import queries as llm
else:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

ACTION_COLUMNS = [part.split()[0] for part in ACTION_SCHEMA.split(",")]
TASK = "task"
FLOW = "1,2,3,4,5,6,7"
TIES = ("event_id",)
SAMPLE_TOTAL = 900
SEED = "_7"

BY_AGE = sessions.SessionFilter(start_age=20, end_age=50)
BY_EVERYTHING = sessions.SessionFilter(
    start_age=5,
    end_age=55,
    professionals="BUILDING,MACHINERY,AUTOMOBILE",
    cities=[f"NATION_{i}" for i in (1, 2, 3, 5, 8, 13, 15, 18, 20, 21, 22)],
    sex="female",
    keywords="kw1,kw4,kw7,kw9",
    category_ids="1,2,3,5,12,17",
)


# --- scans and functions -----------------------------------------------------------------------

def actions_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = "2024-01-08", "2024-01-14"
    rows = retail.actions(spark, sf_dir, first, last)
    return actions_between(rows, first, last).select(*ACTION_COLUMNS)


def users_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.users(spark, sf_dir)


def click_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks(retail.actions(spark, sf_dir))


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    noon = F.lit("2024-01-15 12:00:00")
    day = F.to_date("date")
    city = F.col("city_id").cast("string")
    page = F.col("page_id").cast("string")
    packed = F.concat(
        F.lit("page="), page, F.lit("|keyword="), F.coalesce("search_keyword", F.lit(""))
    )
    return retail.actions(spark, sf_dir).select(
        "event_id",
        times.date_key("action_ts").alias("date_key"),
        times.minute_key("action_ts").alias("minute_key"),
        times.date_hour("action_time").alias("date_hour"),
        times.format_date(times.parse_date_key(times.date_key("action_ts"))).alias("parsed_date"),
        times.is_before(F.col("action_time"), noon).alias("before_noon_15"),
        times.is_after(F.col("action_time"), noon).alias("after_noon_15"),
        times.seconds_between(F.col("action_time"), F.lit("2024-01-01 5:07:09")).alias("seconds"),
        times.today(day).alias("today"),
        times.yesterday(day).alias("yesterday"),
        texts.is_empty(F.col("search_keyword")).alias("keyword_empty"),
        texts.is_not_empty(F.col("search_keyword")).alias("keyword_given"),
        texts.trim_comma(F.concat(F.lit(","), "order_category_ids", F.lit(","))).alias("trimmed"),
        texts.two_digits(city).alias("two_digits"),
        texts.packed_field(packed, "|", "keyword").alias("packed_keyword"),
        texts.packed_field(packed, "|", "page").alias("packed_page"),
        texts.set_packed_field(packed, "|", "page", (F.col("page_id") + 1).cast("string"))
        .alias("repacked"),
        texts.json_field(F.concat(F.lit('{"page": '), page, F.lit("}")), "page").alias("json_page"),
        texts.id_and_name(F.col("city_id"), F.col("date")).alias("id_and_name"),
        numbers.format_double(F.col("event_id") / 8, 2).alias("eighths"),
    )


# --- sessions ----------------------------------------------------------------------------------

def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_rollup(retail.actions(spark, sf_dir))


def session_full_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_full_info(session_rollup(spark, sf_dir), retail.users(spark, sf_dir))


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filter_sessions(session_full_info(spark, sf_dir), BY_EVERYTHING)


def _kept(
    spark: SparkSession,
    sf_dir: str,
    conditions: sessions.SessionFilter = BY_AGE,
    gap: bool = False,
) -> DataFrame:
    return sessions.kept_sessions(
        retail.actions(spark, sf_dir, gap=gap), retail.users(spark, sf_dir), conditions
    )


def session_filter_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir, BY_EVERYTHING).drop("start_ts")


def filtered_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _kept(spark, sf_dir, BY_EVERYTHING)
    return sessions.filtered_actions(retail.actions(spark, sf_dir), kept).select(*ACTION_COLUMNS)


def session_stat_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_stat_ratio(_kept(spark, sf_dir), TASK)


def session_stat_ratio_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = sessions.SessionFilter()
    return sessions.session_stat_ratio(_kept(spark, sf_dir, everyone, gap=True), TASK)


def session_hour_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hour_quotas(_kept(spark, sf_dir), SAMPLE_TOTAL)


def session_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retail.actions(spark, sf_dir)
    return sampling.session_extract(rows, _kept(spark, sf_dir), TASK, SAMPLE_TOTAL, SEED)


def session_stat_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares as counted while the kept sessions are written."""
    counted = Observation("sessions")
    root = scratch_dir(spark, "kept-sessions")
    plain.replace(sessions.observed(_kept(spark, sf_dir), counted), root)
    remove(spark, root)
    return sessions.session_stat_of(spark, counted, TASK)


# --- stored layouts ----------------------------------------------------------------------------

def _stored_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.actions(spark, sf_dir).select(*ACTION_COLUMNS)


def actions_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of days, from actions stored by date."""
    path = scratch_dir(spark, "actions-by-date")
    layouts.write_by_date(_stored_actions(spark, sf_dir), path)
    stored = layouts.read_by_date(spark, path, ACTION_SCHEMA)
    return actions_between(stored, "2024-01-08", "2024-01-14").select(*ACTION_COLUMNS)


def filtered_actions_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions of kept sessions, from actions stored in buckets of sessions."""
    table = f"actions_{uuid4().hex}"
    layouts.write_by_session(_stored_actions(spark, sf_dir), table, 16)
    stored = spark.table(table)
    kept = sessions.kept_sessions(stored, retail.users(spark, sf_dir), BY_EVERYTHING)
    return sessions.filtered_actions(stored, kept).select(*ACTION_COLUMNS)


# --- categories --------------------------------------------------------------------------------

def category_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_event_counts(retail.actions(spark, sf_dir))


def category_full_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_full_counts(retail.actions(spark, sf_dir))


def session_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sessions.filtered_actions(retail.actions(spark, sf_dir), _kept(spark, sf_dir))
    return categories.session_category_counts(rows)


def _top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sessions.filtered_actions(retail.actions(spark, sf_dir), _kept(spark, sf_dir))
    return categories.top_categories(categories.category_full_counts(rows))


def top10_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.top_category_report(_top_categories(spark, sf_dir), TASK)


def category_session_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_session_clicks(
        retail.actions(spark, sf_dir), _top_categories(spark, sf_dir), _kept(spark, sf_dir)
    )


def top10_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = categories.top_sessions(category_session_clicks(spark, sf_dir))
    return categories.top_session_report(top, TASK)


# --- page flow ---------------------------------------------------------------------------------

def page_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = successor_pairs(
        retail.actions(spark, sf_dir), "session_id", "page_id", ["action_ts", *TIES], "action_ts"
    )
    return pairs.groupBy("page_id", F.col("next_value").alias("next_page")).agg(
        F.count(F.lit(1)).alias("pair_count")
    )


def page_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.page_pair_counts(retail.actions(spark, sf_dir), FLOW, TIES)


def start_page_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.start_page_views(retail.actions(spark, sf_dir), FLOW)


def page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.page_convert_rates(retail.actions(spark, sf_dir), FLOW, TIES)


def page_split_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.page_split_convert_rate(page_convert_rate(spark, sf_dir), TASK)


# --- areas -------------------------------------------------------------------------------------

def area_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_clicks(click_scan(spark, sf_dir), retail.cities(spark, sf_dir))


def area_product_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_product_counts(click_scan(spark, sf_dir), retail.cities(spark, sf_dir))


def area_product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = area_product_counts(spark, sf_dir)
    return areas.area_product_info(counts, retail.products(spark, sf_dir))


def area_top3_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts with product names go through a named view, as a SQL user would have them."""
    plain.register(area_product_info(spark, sf_dir), "area_product_info")
    return areas.area_top_products(spark.table("area_product_info"), TASK, retail.LEVELS)


def area_top3_inline_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the inline cities, which are ten, and their own area levels."""
    rows = click_scan(spark, sf_dir).withColumn("city_id", F.col("city_id") % 10)
    counts = areas.area_product_counts(rows, city_dimension(spark))
    info = areas.area_product_info(counts, retail.products(spark, sf_dir))
    return areas.area_top_products(info, TASK)


def area_top3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as SQL text, with functions of the session."""
    sql.register(spark, retail.LEVELS)
    views = {
        "actions": retail.actions(spark, sf_dir), "cities": retail.cities(spark, sf_dir),
        "products": retail.products(spark, sf_dir),
    }
    return reports.run(spark, reports.AREA_TOP_PRODUCTS, views, taskid=TASK, top=3)


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every SQL function on every action."""
    sql.register(spark, retail.LEVELS)
    return reports.run(spark, """
        WITH packed AS (
            SELECT *, concat('page=', page_id, '|keyword=', coalesce(search_keyword, '')) AS record
            FROM actions
        )
        SELECT event_id, is_empty(search_keyword) AS keyword_empty,
               is_not_empty(search_keyword) AS keyword_given,
               trim_comma(concat(',', order_category_ids, ',')) AS trimmed,
               two_digits(CAST(city_id AS STRING)) AS two_digits,
               id_and_name(city_id, date, ':') AS id_and_name,
               json_field(concat('{"page": ', page_id, '}'), 'page') AS json_page,
               distinct_list(split(order_category_ids, ',')) AS categories,
               packed_field(record, '|', 'keyword') AS packed_keyword,
               set_packed_field(record, '|', 'page', CAST(page_id + 1 AS STRING)) AS repacked,
               date_key(action_ts) AS date_key, minute_key(action_ts) AS minute_key,
               product_status(concat('{"product_status": ', page_id % 2, '}')) AS product_status,
               area_level(if(page_id % 2 = 0, 'ASIA', 'EUROPE')) AS area_level
        FROM packed
    """, {"actions": retail.actions(spark, sf_dir)})


# --- ads ---------------------------------------------------------------------------------------

def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ad_log(retail.ad_lines(spark, sf_dir))


def ad_log_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).withColumn("ts_ms", F.unix_millis("ts")).drop("ts")


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.users(spark, sf_dir).where(
        F.col("professional").isin("BUILDING", "FURNITURE")
    ).select(F.col("user_id").alias("userid"))


def ad_log_not_blacklisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.not_blacklisted(_log(spark, sf_dir), _listed(spark, sf_dir)).drop("ts")


def _streamed(
    spark: SparkSession, sf_dir: str, start, prepare=None, arrivals: bool = False, **options
) -> AdTables:
    """The tables that a stream over the whole events table has filled."""
    root = scratch_dir(pin_utc(spark), start.__name__)
    tables = AdTables(f"{root}/tables")
    if prepare is not None:
        prepare(tables)
    lines = retail.ad_lines(spark, sf_dir, stream=True)
    lines = _arriving(lines) if arrivals else lines.select("value")
    query = start(lines, tables, f"{root}/checkpoint", available_now=True, **options)
    query.awaitTermination()
    remove(spark, f"{root}/checkpoint")
    return tables


def ad_click_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user and ad on every day, looked up in the stored counts."""
    log = _log(spark, sf_dir)
    stored = _streamed(spark, sf_dir, live.start_user_clicks).user_clicks.read(spark)
    first, last = (
        times.parse_date_key(log.agg(edge("date").alias("date")).scalar()) for edge in (F.min, F.max)
    )
    days = F.explode(F.sequence(first, last))
    keys = log.select("userid", "adid").distinct().select("userid", "adid", days.alias("day"))
    return ads.click_counts_of(keys.withColumn("date", times.date_key("day")), stored)


def ad_user_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_user_clicks).user_clicks.read(spark)


def ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_blacklist, threshold=1).blacklist.read(spark)


def ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_ad_stat).stat.read(spark)


def ad_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_ad_stat, with_top3=True).top3.read(spark)


def ad_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_click_trend).trend.read(spark)


def ad_click_sliding_hour_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.sliding_hours(spark, _streamed(spark, sf_dir, live.start_sliding_hour))


def ad_running_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, live.start_running_stat).running_stat.read(spark)


def _arriving(lines: DataFrame) -> DataFrame:
    """Lines that come up to six minutes after their time, by the second they are from."""
    delay = F.expr("make_interval(0, 0, 0, 0, 0, second(ts) % 7)")
    return lines.select("value", (F.col("ts") + delay).alias("arrived"))


def ad_click_arrival_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = parse_ad_log(_arriving(retail.ad_lines(spark, sf_dir)), "arrived")
    return ads.arrival_hour(ads.arrival_panes(log))


def ad_click_arrival_hour_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _streamed(spark, sf_dir, live.start_arrival_hour, arrivals=True)
    return live.arrival_reports(spark, tables)


def _whole_job(spark: SparkSession, sf_dir: str) -> AdTables:
    """The whole ad job, with some users on the blacklist before it starts.

    No user gets on it later, so the result doesn't depend on how the feed is cut.
    """
    def prepare(tables: AdTables) -> None:
        tables.blacklist.write_batch(_listed(spark, sf_dir), -1)

    return _streamed(spark, sf_dir, live.start_ad_job, prepare, threshold=1 << 40)


def ad_job_user_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_job(spark, sf_dir).user_clicks.read(spark)


def ad_job_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_job(spark, sf_dir).stat.read(spark)


def ad_job_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_job(spark, sf_dir).top3.read(spark)


def ad_job_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_job(spark, sf_dir).trend.read(spark)


def ad_click_sliding_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.sliding_hour(_log(spark, sf_dir))


# --- sinks -------------------------------------------------------------------------------------

def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of counts through every kind of sink, then all sinks read back."""
    root = scratch_dir(spark, "sinks")
    rows = retail.events(spark, sf_dir)
    early = F.col("event_type").isin("click", "view")
    log = rows.join(
        retail.table(spark, sf_dir, "nation"), F.col("user_id") % 25 == F.col("n_nationkey")
    ).select(
        early.alias("early"),
        times.date_key("ts").alias("date"),
        F.col("n_regionkey").cast("string").alias("province"),
        (F.col("k") % 20).cast("bigint").alias("adid"),
    )
    batches = []
    for batch_id, part in enumerate((F.col("early"), ~F.col("early"))):
        counts = log.where(part).groupBy("date", "province", "adid").agg(
            F.count(F.lit(1)).alias("clickCount")
        )
        plain.replace(counts, f"{root}/batches/{batch_id}")
        batches.append(spark.read.schema(TOP3).parquet(f"{root}/batches/{batch_id}"))
    ad_keys = ("date", "province", "adid")
    stores = {
        "add": keyed.KeyedTable(f"{root}/add", TOP3, ad_keys, keyed.ADD, "clickCount", "date"),
        "overwrite": keyed.KeyedTable(
            f"{root}/overwrite", TOP3, ad_keys, keyed.OVERWRITE, "clickCount", "date"),
        "replace_group": keyed.KeyedTable(
            f"{root}/group", TOP3, ad_keys[:2], keyed.REPLACE_GROUP, partition="date"),
        "insert": keyed.KeyedTable(f"{root}/insert", "adid bigint", ("adid",), keyed.INSERT),
    }
    for batch_id, batch in enumerate(batches):
        plain.append(batch, f"{root}/append")
        plain.replace(batch, f"{root}/replace")
        for name, store in stores.items():
            store.write_batch(batch.select("adid") if name == "insert" else batch, batch_id)
    found = {
        "append": spark.read.schema(TOP3).parquet(f"{root}/append"),
        "replace": spark.read.schema(TOP3).parquet(f"{root}/replace"),
        **{name: store.read(spark) for name, store in stores.items()},
    }
    columns = ["sink", *batches[0].columns]
    result = None
    for name, frame in found.items():
        labelled = frame.withColumn("sink", F.lit(name))
        if result is None:
            result = labelled.select(*columns)
        else:
            result = result.unionByName(labelled, allowMissingColumns=True).select(*columns)
    return result


_QUERIES: list[Query] = [
    actions_date_range, users_scan, scalar_functions,
    session_rollup, session_full_info, session_filter, session_filter_flags, filtered_actions,
    session_stat_ratio, session_stat_ratio_gap, session_hour_quotas, session_extract,
    session_stat_observed, actions_by_date, filtered_actions_by_session,
    category_event_counts, category_full_counts, session_category_counts,
    top10_category, category_session_clicks, top10_session,
    page_successors, page_pair_counts, start_page_pv, page_convert_rate, page_split_convert_rate,
    click_scan, area_clicks, area_product_counts, area_product_info, area_top3_product,
    area_top3_inline_cities, area_top3_sql, sql_functions,
    ad_log_parsed, ad_log_not_blacklisted, ad_user_click_count, ad_click_lookup, ad_blacklist,
    ad_stat, ad_province_top3, ad_click_trend, ad_click_sliding_hour,
    ad_click_sliding_hour_stream, ad_click_arrival_hour, ad_click_arrival_hour_stream,
    ad_running_stat, ad_job_user_clicks, ad_job_stat, ad_job_province_top3,
    ad_job_click_trend,
    sink_round_trip,
]


def entry(spark: SparkSession) -> DataFrame:
    """Top 3 products of each area: scan, joins, distinct lists, rank and labels in one plan."""
    return area_top3_product(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {q.__name__: q for q in _QUERIES}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(STATEMENTS)
    if llm is not None:
        found |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
