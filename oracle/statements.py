"""One statement per registered query; the input views come in as common table expressions."""

from __future__ import annotations

# --- the input views of FIXTURES.md ---------------------------------------------------------

_VIEWS = {
    "ev": """
        SELECT event_id, user_id, event_type, ts,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events
    """,
    "gaps": """
        SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS starts
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
    "named": """
        SELECT *,
               user_id || '_' || CASE user_id % 3
                   WHEN 0 THEN strftime(ts, '%Y%m%d')
                   WHEN 1 THEN 'w' || strftime(date_trunc('week', ts), '%Y%m%d')
                   ELSE strftime(ts, '%Y%m') END AS grain_id,
               user_id || '_' || sum(starts) OVER (
                   PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS gap_id
        FROM gaps
    """,
    "act_ids": """
        SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, grain_id, gap_id,
               CAST(k % 10 AS BIGINT) AS page_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
               CASE WHEN event_type = 'signup' THEN 'kw' || (k % 10) END AS search_keyword,
               CAST(CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS BIGINT)
                   AS click_category_id,
               CAST(CASE WHEN event_type = 'click' THEN event_id % 40 ELSE -1 END AS BIGINT)
                   AS click_product_id,
               CASE WHEN event_type = 'view' THEN (k % 20) || ',' || ((k + 7) % 20) END
                   AS order_category_ids,
               CASE WHEN event_type = 'view' THEN CAST(event_id % 40 AS VARCHAR) END
                   AS order_product_ids,
               CASE WHEN event_type = 'purchase' THEN (k % 20) || ',' || ((k + 3) % 20) END
                   AS pay_category_ids,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id % 40 AS VARCHAR) END
                   AS pay_product_ids,
               user_id % 25 AS city_id, event_id, ts, date_trunc('second', ts) AS action_ts
        FROM named
    """,
    "act": "SELECT *, grain_id AS session_id FROM act_ids",
    "act_gap": "SELECT *, gap_id AS session_id FROM act_ids",
    "usr": """
        SELECT c_custkey AS user_id, CAST(c_custkey % 60 AS INTEGER) AS age,
               c_mktsegment AS professional, n_name AS city,
               CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
    "prod": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               '{"product_status": ' || (p_size % 2) || '}' AS extend_info
        FROM part
    """,
    "cit": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "ad": """
        SELECT ts, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%Y%m%d%H%M') AS minute_key,
               CAST(n_regionkey AS VARCHAR) AS province, CAST(user_id % 25 AS VARCHAR) AS city,
               user_id AS userid, CAST(k % 20 AS BIGINT) AS adid, event_type
        FROM ev JOIN nation ON user_id % 25 = n_nationkey
    """,
    # --- sessions ---------------------------------------------------------------------------
    "rolled": """
        SELECT session_id, min(user_id) AS user_id,
               array_to_string(list_sort(list(DISTINCT search_keyword)
                   FILTER (search_keyword <> '')), ',') AS search_keywords,
               array_to_string(list_sort(list(DISTINCT click_category_id)
                   FILTER (click_category_id <> -1)), ',') AS click_category_ids,
               date_diff('second', min(action_ts), max(action_ts)) AS visit_length,
               count(*) AS step_length, min(action_ts) AS start_ts,
               strftime(min(action_ts), '%Y-%m-%d %H:%M:%S') AS start_time
        FROM act GROUP BY session_id
    """,
    "info": """
        SELECT r.*, u.age, u.professional, u.sex, u.city
        FROM rolled r JOIN usr u ON r.user_id = u.user_id
    """,
    "kept": "SELECT * FROM info WHERE age BETWEEN 20 AND 50",
    "narrow": """
        SELECT * FROM info
        WHERE age BETWEEN 5 AND 55
          AND professional IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
          AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13',
                       'NATION_15', 'NATION_18', 'NATION_20', 'NATION_21', 'NATION_22')
          AND sex = 'female'
          AND list_has_any(string_split(search_keywords, ','), ['kw1', 'kw4', 'kw7', 'kw9'])
          AND list_has_any(string_split(click_category_ids, ','),
                           ['1', '2', '3', '5', '12', '17'])
    """,
    "gap_kept": """
        SELECT date_diff('second', min(action_ts), max(action_ts)) AS visit_length,
               count(*) AS step_length
        FROM act_gap WHERE user_id IN (SELECT user_id FROM usr) GROUP BY session_id
    """,
    # --- categories -------------------------------------------------------------------------
    "touch": """
        SELECT session_id, click_category_id AS category_id, 'click' AS kind
        FROM act WHERE click_category_id <> -1
        UNION ALL
        SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order'
        FROM act WHERE order_category_ids IS NOT NULL
        UNION ALL
        SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay'
        FROM act WHERE pay_category_ids IS NOT NULL
    """,
    "kept_touch": "SELECT * FROM touch WHERE session_id IN (SELECT session_id FROM kept)",
    "top_cat": """
        SELECT category_id, count(*) FILTER (kind = 'click') AS click_count,
               count(*) FILTER (kind = 'order') AS order_count,
               count(*) FILTER (kind = 'pay') AS pay_count
        FROM kept_touch GROUP BY category_id
        ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
    """,
    "cat_session": """
        SELECT category_id, session_id, count(*) AS click_count
        FROM kept_touch
        WHERE kind = 'click' AND category_id IN (SELECT category_id FROM top_cat)
        GROUP BY category_id, session_id
    """,
    # --- page flow --------------------------------------------------------------------------
    "nexts": """
        SELECT page_id, lead(page_id) OVER (PARTITION BY session_id
                                            ORDER BY action_ts, event_id) AS next_page
        FROM act
    """,
    "pair_counts": """
        SELECT page_id || '_' || next_page AS page_pair, count(*) AS pair_count
        FROM nexts
        WHERE (page_id, next_page) IN ((1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7))
        GROUP BY ALL
    """,
    "steps": """
        SELECT pos, (pos + 1) || '_' || (pos + 2) AS page_pair FROM range(6) AS r(pos)
    """,
    "rates": """
        SELECT CAST(pos AS INTEGER) AS pos, page_pair, pair_count, base_count,
               CASE WHEN base_count = 0 THEN NULL
                    ELSE ((200 * pair_count + base_count) // (2 * base_count)) / 100.0
               END AS convert_rate
        FROM (
            SELECT pos, s.page_pair, coalesce(pair_count, 0) AS pair_count,
                   coalesce(lag(coalesce(pair_count, 0)) OVER (ORDER BY pos),
                            (SELECT count(*) FROM act WHERE page_id = 1)) AS base_count
            FROM steps s LEFT JOIN pair_counts c ON s.page_pair = c.page_pair
        )
    """,
    # --- areas ------------------------------------------------------------------------------
    "ac": """
        SELECT act.city_id, city_name, area, click_product_id AS pid
        FROM act JOIN cit ON act.city_id = cit.city_id WHERE click_product_id <> -1
    """,
    "apc": """
        SELECT area, pid, count(*) AS click_count,
               string_agg(DISTINCT city_id || ':' || city_name, ','
                          ORDER BY city_id || ':' || city_name) AS city_infos
        FROM ac GROUP BY area, pid
    """,
    "api": """
        SELECT area, city_infos, pid, product_name,
               CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
                    THEN 'Self' ELSE 'Third Party' END AS product_status,
               click_count
        FROM apc JOIN prod ON pid = product_id
    """,
    # --- ads --------------------------------------------------------------------------------
    "uac": """
        SELECT date, userid, adid, count(*) AS "clickCount" FROM ad GROUP BY ALL
    """,
    "st": """
        SELECT date, province, city, adid, count(*) AS "clickCount" FROM ad GROUP BY ALL
    """,
    "clean": """
        SELECT * FROM ad WHERE userid NOT IN (
            SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))
    """,
    "first_half": """
        SELECT date, province, adid, count(*) AS "clickCount" FROM ad
        WHERE event_type IN ('click', 'view') GROUP BY ALL
    """,
    "second_half": """
        SELECT date, province, adid, count(*) AS "clickCount" FROM ad
        WHERE event_type NOT IN ('click', 'view') GROUP BY ALL
    """,
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _VIEWS.items()) + "\n"

_VISITS = (
    ("1s_3s", "BETWEEN 1 AND 3"), ("4s_6s", "BETWEEN 4 AND 6"), ("7s_9s", "BETWEEN 7 AND 9"),
    ("10s_30s", "BETWEEN 10 AND 30"), ("30s_60s", "BETWEEN 31 AND 60"),
    ("1m_3m", "BETWEEN 61 AND 180"), ("3m_10m", "BETWEEN 181 AND 600"),
    ("10m_30m", "BETWEEN 601 AND 1800"), ("30m", "> 1800"),
)
_STEPS = (
    ("1_3", "BETWEEN 1 AND 3"), ("4_6", "BETWEEN 4 AND 6"), ("7_9", "BETWEEN 7 AND 9"),
    ("10_30", "BETWEEN 10 AND 30"), ("30_60", "BETWEEN 31 AND 60"), ("60", "> 60"),
)


def _ratios(sessions: str) -> str:
    shares = [
        f"coalesce((200 * count(*) FILTER ({column} {test}) + count(*))"
        f" // nullif(2 * count(*), 0), 0) / 100.0"
        f" AS {column}_{name}_ratio"
        for column, buckets in (("visit_length", _VISITS), ("step_length", _STEPS))
        for name, test in buckets
    ]
    return f"SELECT 'task' AS taskid, count(*) AS session_count, {', '.join(shares)} FROM {sessions}"


_ACTION_COLUMNS = """
    date, user_id, session_id, page_id, action_time, search_keyword, click_category_id,
    click_product_id, order_category_ids, order_product_ids, pay_category_ids,
    pay_product_ids, city_id
"""
_SESSION_COLUMNS = """
    session_id, user_id, search_keywords, click_category_ids, visit_length, step_length, start_time
"""

_BODIES = {
    "actions_date_range":
        f"SELECT {_ACTION_COLUMNS} FROM act WHERE date BETWEEN '2024-01-08' AND '2024-01-14'",
    "users_scan": """
        SELECT c_custkey AS user_id, c_name AS username, c_name AS name, age, professional,
               city, sex
        FROM usr JOIN customer ON user_id = c_custkey
    """,
    "scalar_functions": """
        SELECT event_id,
               strftime(action_ts, '%Y%m%d') AS date_key,
               strftime(action_ts, '%Y%m%d%H%M') AS minute_key,
               strftime(action_ts, '%Y-%m-%d_%H') AS date_hour,
               strftime(action_ts, '%Y-%m-%d') AS parsed_date,
               action_ts < TIMESTAMP '2024-01-15 12:00:00' AS before_noon_15,
               action_ts > TIMESTAMP '2024-01-15 12:00:00' AS after_noon_15,
               date_diff('second', TIMESTAMP '2024-01-01 05:07:09', action_ts) AS seconds,
               strftime(action_ts, '%Y-%m-%d') AS today,
               strftime(action_ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday,
               coalesce(search_keyword, '') = '' AS keyword_empty,
               coalesce(search_keyword, '') <> '' AS keyword_given,
               order_category_ids AS trimmed,
               CASE WHEN length(CAST(city_id AS VARCHAR)) = 2 THEN CAST(city_id AS VARCHAR)
                    ELSE '0' || city_id END AS two_digits,
               search_keyword AS packed_keyword,
               CAST(page_id AS VARCHAR) AS packed_page,
               'page=' || (page_id + 1) || '|keyword=' || coalesce(search_keyword, '')
                   AS repacked,
               CAST(page_id AS VARCHAR) AS json_page,
               city_id || ':' || date AS id_and_name,
               round(event_id / 8.0, 2) AS eighths
        FROM act
    """,
    "sql_functions": """
        SELECT event_id, coalesce(search_keyword, '') = '' AS keyword_empty,
               coalesce(search_keyword, '') <> '' AS keyword_given, order_category_ids AS trimmed,
               lpad(CAST(city_id AS VARCHAR), 2, '0') AS two_digits,
               city_id || ':' || date AS id_and_name, CAST(page_id AS VARCHAR) AS json_page,
               array_to_string(list_sort(list_distinct(string_split(order_category_ids, ','))), ',')
                   AS categories,
               search_keyword AS packed_keyword,
               'page=' || (page_id + 1) || '|keyword=' || coalesce(search_keyword, '') AS repacked,
               strftime(action_ts, '%Y%m%d') AS date_key,
               strftime(action_ts, '%Y%m%d%H%M') AS minute_key,
               CASE WHEN page_id % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status,
               CASE WHEN page_id % 2 = 0 THEN 'B_Level' ELSE 'C_Level' END AS area_level
        FROM act
    """,
    "session_rollup": f"SELECT {_SESSION_COLUMNS} FROM rolled",
    "session_full_info":
        f"SELECT {_SESSION_COLUMNS}, age, professional, sex, city FROM info",
    "session_filter":
        f"SELECT {_SESSION_COLUMNS}, age, professional, sex, city FROM narrow",
    "session_filter_flags":
        "SELECT session_id, user_id, visit_length, step_length FROM narrow",
    "filtered_actions":
        f"SELECT {_ACTION_COLUMNS} FROM act WHERE session_id IN (SELECT session_id FROM narrow)",
    "session_stat_ratio": _ratios("kept"),
    "session_stat_ratio_gap": _ratios("gap_kept"),
    "session_hour_quotas": """
        SELECT * FROM (
            SELECT date, hour, hour_count, CAST(day_count AS BIGINT) AS day_count,
                   least(hour_count, CAST(hour_count * (900 // days) // day_count AS BIGINT))
                       AS quota
            FROM (
                SELECT date, hour, count(*) AS hour_count, any_value(days) AS days,
                       sum(count(*)) OVER (PARTITION BY date) AS day_count
                FROM (SELECT strftime(start_ts, '%Y-%m-%d') AS date,
                             strftime(start_ts, '%H') AS hour,
                             (SELECT count(DISTINCT CAST(start_ts AS DATE)) FROM kept) AS days
                      FROM kept)
                GROUP BY date, hour
            )
        ) WHERE quota > 0
    """,
    "session_extract": """
        SELECT 'task' AS taskid, session_id AS sessionid, start_time AS "startTime",
               search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds"
        FROM (
            SELECT *,
                   count(*) OVER (PARTITION BY date_trunc('hour', start_ts)) AS in_hour,
                   count(*) OVER (PARTITION BY CAST(start_ts AS DATE)) AS in_day,
                   900 // (SELECT count(DISTINCT CAST(start_ts AS DATE)) FROM kept) AS per_day,
                   row_number() OVER (PARTITION BY date_trunc('hour', start_ts)
                                      ORDER BY md5(session_id || '_7'), session_id) AS pick
            FROM kept
        ) WHERE pick <= in_hour * per_day // in_day
    """,
    "category_event_counts":
        "SELECT category_id, kind, count(*) AS event_count FROM touch GROUP BY category_id, kind",
    "category_full_counts": """
        SELECT c.category_id, coalesce(clicks, 0) AS click_count,
               coalesce(orders, 0) AS order_count, coalesce(pays, 0) AS pay_count
        FROM (SELECT DISTINCT category_id FROM touch) c
        LEFT JOIN (SELECT category_id, count(*) AS clicks FROM touch WHERE kind = 'click'
                   GROUP BY 1) a ON c.category_id = a.category_id
        LEFT JOIN (SELECT category_id, count(*) AS orders FROM touch WHERE kind = 'order'
                   GROUP BY 1) b ON c.category_id = b.category_id
        LEFT JOIN (SELECT category_id, count(*) AS pays FROM touch WHERE kind = 'pay'
                   GROUP BY 1) d ON c.category_id = d.category_id
    """,
    "session_category_counts": """
        SELECT session_id, category_id, count(*) FILTER (kind = 'click') AS click_count,
               count(*) FILTER (kind = 'order') AS order_count,
               count(*) FILTER (kind = 'pay') AS pay_count
        FROM kept_touch GROUP BY session_id, category_id
    """,
    "top10_category": """
        SELECT 'task' AS taskid, category_id AS categoryid, click_count AS "clickCount",
               order_count AS "orderCount", pay_count AS "payCount" FROM top_cat
    """,
    "category_session_clicks": "SELECT category_id, session_id, click_count FROM cat_session",
    "top10_session": """
        SELECT 'task' AS taskid, category_id AS categoryid, session_id AS sessionid,
               click_count AS "clickCount"
        FROM cat_session
        QUALIFY row_number() OVER (PARTITION BY category_id
                                   ORDER BY click_count DESC, session_id) <= 10
    """,
    "page_successors": """
        SELECT page_id, next_page, count(*) AS pair_count FROM nexts
        WHERE next_page IS NOT NULL GROUP BY page_id, next_page
    """,
    "page_pair_counts": "SELECT page_pair, pair_count FROM pair_counts",
    "start_page_pv": "SELECT count(*) AS start_page_pv FROM act WHERE page_id = 1",
    "page_convert_rate": "SELECT pos, page_pair, pair_count, base_count, convert_rate FROM rates",
    "page_split_convert_rate": """
        SELECT 'task' AS taskid,
               string_agg(page_pair || '=' || coalesce(CAST(CAST(convert_rate AS DOUBLE) AS VARCHAR), ''),
                          '|' ORDER BY pos) AS "convertRate"
        FROM rates
    """,
    "click_scan":
        "SELECT city_id, click_product_id FROM act WHERE click_product_id <> -1",
    "area_clicks": "SELECT city_id, city_name, area, pid FROM ac",
    "area_product_counts": "SELECT area, pid, click_count, city_infos FROM apc",
    "area_product_info":
        "SELECT area, city_infos, pid, product_name, product_status, click_count FROM api",
    "area_top3_product": """
        SELECT 'task' AS taskid, area,
               CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A_Level'
                    WHEN area = 'ASIA' THEN 'B_Level'
                    WHEN area = 'EUROPE' THEN 'C_Level'
                    ELSE 'D_Level' END AS "areaLevel",
               pid AS productid, city_infos AS "cityInfos", click_count AS "clickCount",
               product_name AS "productName", product_status AS "productStatus"
        FROM api
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) <= 3
    """,
    "area_top3_inline_cities": """
        SELECT 'task' AS taskid, area,
               CASE WHEN area IN ('华北', '华东') THEN 'A_Level'
                    WHEN area IN ('华中', '华南') THEN 'B_Level'
                    WHEN area IN ('西南', '西北') THEN 'C_Level'
                    ELSE 'D_Level' END AS "areaLevel",
               pid AS productid, city_infos AS "cityInfos", click_count AS "clickCount",
               product_name AS "productName",
               CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
                    THEN 'Self' ELSE 'Third Party' END AS "productStatus"
        FROM (
            SELECT area, click_product_id AS pid, count(*) AS click_count,
                   string_agg(DISTINCT c.city_id || ':' || city_name, ','
                              ORDER BY c.city_id || ':' || city_name) AS city_infos
            FROM act JOIN (VALUES
                (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
                (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
                (8, '成都', '西南'), (9, '哈尔滨', '东北')) AS c(city_id, city_name, area)
            ON act.city_id % 10 = c.city_id
            WHERE click_product_id <> -1 GROUP BY area, click_product_id
        ) JOIN prod ON pid = product_id
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) <= 3
    """,
    "ad_log_parsed": """
        SELECT date, minute_key, epoch_us(ts) // 1000 AS ts_ms, province, city, userid, adid FROM ad
    """,
    "ad_log_not_blacklisted": """
        SELECT date, minute_key, province, city, userid, adid FROM ad
        WHERE userid NOT IN (
            SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))
    """,
    "ad_user_click_count": 'SELECT date, userid, adid, "clickCount" FROM uac',
    "ad_click_lookup": """
        SELECT d.date, u.userid, u.adid, coalesce(uac."clickCount", 0) AS "clickCount"
        FROM (SELECT DISTINCT userid, adid FROM ad) u
        CROSS JOIN (SELECT strftime(unnest(generate_series(
            min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)), '%Y%m%d') AS date FROM ad) d
        LEFT JOIN uac ON uac.date = d.date AND uac.userid = u.userid AND uac.adid = u.adid
    """,
    "ad_blacklist": 'SELECT DISTINCT userid FROM uac WHERE "clickCount" > 1',
    "ad_stat": 'SELECT date, province, city, adid, "clickCount" FROM st',
    "ad_province_top3": """
        SELECT date, province, adid, "clickCount" FROM (
            SELECT date, province, adid, CAST(sum("clickCount") AS BIGINT) AS "clickCount"
            FROM st GROUP BY date, province, adid)
        QUALIFY row_number() OVER (PARTITION BY date, province
                                   ORDER BY "clickCount" DESC, adid) <= 3
    """,
    "sink_round_trip": """
        SELECT 'append' AS sink, * FROM (
            SELECT * FROM first_half UNION ALL SELECT * FROM second_half)
        UNION ALL
        SELECT 'replace', * FROM second_half
        UNION ALL
        SELECT 'add', date, province, adid, CAST(sum("clickCount") AS BIGINT) FROM (
            SELECT * FROM first_half UNION ALL SELECT * FROM second_half)
        GROUP BY date, province, adid
        UNION ALL
        SELECT 'overwrite', * FROM second_half
        UNION ALL
        SELECT 'overwrite', f.* FROM first_half f
        ANTI JOIN second_half s ON f.date = s.date AND f.province = s.province AND f.adid = s.adid
        UNION ALL
        SELECT 'replace_group', * FROM second_half
        UNION ALL
        SELECT 'replace_group', f.* FROM first_half f
        ANTI JOIN second_half s ON f.date = s.date AND f.province = s.province
        UNION ALL
        SELECT DISTINCT 'insert', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), adid,
               CAST(NULL AS BIGINT) FROM ad
    """,
    "ad_click_trend": """
        SELECT date, minute_key[9:10] AS hour, minute_key[11:12] AS minute, adid,
               count(*) AS "clickCount" FROM ad GROUP BY ALL
    """,
    "ad_job_user_clicks":
        'SELECT date, userid, adid, count(*) AS "clickCount" FROM clean GROUP BY ALL',
    "ad_job_stat":
        'SELECT date, province, city, adid, count(*) AS "clickCount" FROM clean GROUP BY ALL',
    "ad_job_province_top3": """
        SELECT date, province, adid, "clickCount" FROM (
            SELECT date, province, adid, count(*) AS "clickCount"
            FROM clean GROUP BY date, province, adid)
        QUALIFY row_number() OVER (PARTITION BY date, province
                                   ORDER BY "clickCount" DESC, adid) <= 3
    """,
    "ad_job_click_trend": """
        SELECT date, minute_key[9:10] AS hour, minute_key[11:12] AS minute, adid,
               count(*) AS "clickCount" FROM clean GROUP BY ALL
    """,
    "ad_click_sliding_hour": """
        SELECT strftime(date_trunc('minute', ts) - to_minutes(CAST(back AS BIGINT)), '%Y%m%d%H%M')
                   AS window_start,
               adid, count(*) AS "clickCount"
        FROM ad, generate_series(0, 59) AS g(back) GROUP BY ALL
    """,
}

_BODIES["ad_click_arrival_hour"] = """
    SELECT strftime(date_trunc('minute', ts + to_minutes(CAST(second(ts) % 7 AS BIGINT)))
                    + to_minutes(CAST(later AS BIGINT)), '%Y%m%d%H%M') AS report_minute,
           date, minute_key[9:10] AS hour, minute_key[11:12] AS minute, adid,
           count(*) AS "clickCount"
    FROM ad, generate_series(0, 59) AS g(later) GROUP BY ALL
"""
_BODIES["ad_click_arrival_hour_stream"] = _BODIES["ad_click_arrival_hour"]
_BODIES["session_stat_observed"] = _BODIES["session_stat_ratio"]
_BODIES["actions_by_date"] = _BODIES["actions_date_range"]
_BODIES["filtered_actions_by_session"] = _BODIES["filtered_actions"]
_BODIES["ad_running_stat"] = _BODIES["ad_stat"]
_BODIES["area_top3_sql"] = _BODIES["area_top3_product"]
_BODIES["ad_click_sliding_hour_stream"] = _BODIES["ad_click_sliding_hour"]

STATEMENTS = {name: _WITH + body for name, body in _BODIES.items()}
