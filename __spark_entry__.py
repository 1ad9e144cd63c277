"""

``entry(spark)`` runs the flagship (top-10 categories) on sf0.001. ``queries()`` maps
every implemented operator/job to a callable ``(spark, sf_dir) -> DataFrame`` over the
whole test tables; ``oracle_sql()`` gives the same computation in DuckDB SQL, with the
test-table mapping of FIXTURES.md section 2 written out as CTEs. Column names and types
are aligned on both sides (counts BIGINT, ranks BIGINT, rates DOUBLE, labels STRING).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import (
    accepted_clicks,
    ad_click_trend,
    ad_click_trend_by_arrival,
    ad_click_trend_windows,
    ads_daily_clicks,
    blacklisted_users,
    category_action_counts,
    category_session_top_n,
    category_top_n,
    filter_time_range,
    page_jump_counts,
    page_jump_rate,
    page_view_counts,
    province_top_ads,
    province_top_ads_json,
    session_page_pairs,
    user_ad_daily_clicks,
)
from clickflow.operators.ads import with_day
from clickflow.sources.adslog import parse_ad_lines
from clickflow.sinks.tables import publish_table
from clickflow.sources.tables import as_actions, read_actions
from clickflow.sources.fixtures import fixture_actions, fixture_ad_clicks, fixture_ad_lines

# The corpus operators are an optional part: without their folder the rest still works.
try:
    import corpus_pipeline
    from clickflow.llm import queries as corpus
except ModuleNotFoundError as missing:
    if (missing.name or "").split(".")[:2] not in (["corpus_pipeline"], ["clickflow", "llm"]):
        raise
    corpus = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

RANGE_START, RANGE_END = "2024-01-05", "2024-01-10 12:00:00"
TARGET_PAGES = [1, 2, 3, 4, 5, 6, 7]
TOP_N = 10
SESSIONS_PER_CATEGORY = 10
TOP_ADS = 3
THRESHOLD = 2
TREND_WINDOW_MS, TREND_SLIDE_MS, TREND_BUCKET_MS = 3_600_000, 600_000, 600_000
ARRIVAL_STEPS, ARRIVAL_STEP_MS = 37, 97_000

CLICK_COLUMNS = ["event_id", "ts_ms", "day", "province", "city", "userid", "adid"]


def _utc(spark: SparkSession) -> None:
    # The oracle reads the NTZ timestamps as UTC; labels are rendered in the session zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return as_actions(fixture_actions(spark, sf_dir), keep=["event_id"])


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ad clicks (the ``ads_log`` view of FIXTURES.md section 2) with a day label."""
    _utc(spark)
    return with_day(fixture_ad_clicks(spark, sf_dir))


def _parsed_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks rebuilt as wire lines and parsed back, as a stream receives them."""
    _utc(spark)
    return with_day(parse_ad_lines(fixture_ad_lines(spark, sf_dir), keep=["event_id"]))


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_click_trend(_clicks(spark, sf_dir), TREND_WINDOW_MS, TREND_SLIDE_MS, TREND_BUCKET_MS)


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks with the stamp of a late arrival, derived from the click: up to an hour."""
    late = F.pmod(F.col("event_id"), F.lit(ARRIVAL_STEPS)) * F.lit(ARRIVAL_STEP_MS)
    return _clicks(spark, sf_dir).withColumn("arrival_ms", F.col("ts_ms") + late)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click log published as a managed table, partitioned by day, and read from the catalog."""
    name = f"clickflow_actions_{uuid.uuid4().hex}"
    publish_table(_actions(spark, sf_dir), name, day_of="action_time")
    return read_actions(spark, table=name)


def entry(spark: SparkSession) -> DataFrame:
    return category_top_n(_actions(spark, SMOKE_DIR), TOP_N)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _click_queries()
    if corpus is not None:
        found |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _click_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "action_range_scan": lambda s, d: filter_time_range(_actions(s, d), RANGE_START, RANGE_END),
        "category_action_counts": lambda s, d: category_action_counts(_actions(s, d)),
        "category_top10": lambda s, d: category_top_n(_actions(s, d), TOP_N),
        "catalog_category_top10": lambda s, d: category_top_n(
            filter_time_range(_published(s, d), RANGE_START, RANGE_END), TOP_N
        ),
        "category_session_top10": lambda s, d: category_session_top_n(
            _actions(s, d), TOP_N, SESSIONS_PER_CATEGORY
        ),
        "session_page_pairs": lambda s, d: session_page_pairs(_actions(s, d)),
        "page_jump_counts": lambda s, d: page_jump_counts(_actions(s, d), TARGET_PAGES).select(
            "page_jump", "jump_count"
        ),
        "page_view_counts": lambda s, d: page_view_counts(_actions(s, d), TARGET_PAGES),
        "page_jump_rate": lambda s, d: page_jump_rate(_actions(s, d), TARGET_PAGES),
        "ads_log_parse": lambda s, d: _parsed_clicks(s, d).select(*CLICK_COLUMNS),
        "ads_daily_clicks": lambda s, d: ads_daily_clicks(_clicks(s, d)),
        "ads_province_top3": lambda s, d: province_top_ads(_clicks(s, d), TOP_ADS),
        "ads_province_top3_json": lambda s, d: province_top_ads_json(province_top_ads(_clicks(s, d), TOP_ADS)),
        "ads_click_trend": lambda s, d: _trend(s, d).drop("window_start_ms"),
        "ads_click_trend_json": lambda s, d: ad_click_trend_windows(
            _clicks(s, d), TREND_WINDOW_MS, TREND_SLIDE_MS, TREND_BUCKET_MS
        ),
        "ads_click_trend_arrival": lambda s, d: ad_click_trend_by_arrival(
            _arrived(s, d), TREND_WINDOW_MS, TREND_SLIDE_MS, TREND_BUCKET_MS
        ).drop("window_start_ms"),
        "user_ad_daily_clicks": lambda s, d: user_ad_daily_clicks(_clicks(s, d)),
        "blacklisted_users": lambda s, d: blacklisted_users(_clicks(s, d), THRESHOLD),
        "accepted_clicks": lambda s, d: accepted_clicks(_clicks(s, d), THRESHOLD).select(*CLICK_COLUMNS),
    }


# ---------------------------------------------------------------------------
# DuckDB oracle. The CTEs restate the test-table mapping independently of Spark.

_BASE = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events
),
ev2 AS (
  SELECT *,
    concat(CAST(1 + k % 20 AS VARCHAR),
           CASE WHEN k % 3 >= 1 THEN concat(',', CAST(1 + (k * 7) % 20 AS VARCHAR)) ELSE '' END,
           CASE WHEN k % 3 = 2 THEN concat(',', CAST(1 + (k * 3) % 20 AS VARCHAR)) ELSE '' END) AS cats
  FROM ev
)"""

_UVA = _BASE + """,
user_visit_action AS (
  SELECT event_id,
    substr(CAST(ts AS VARCHAR), 1, 10) AS date,
    user_id,
    concat(CAST(user_id AS VARCHAR), '-', substr(CAST(ts AS VARCHAR), 1, 7)) AS session_id,
    CAST(1 + k % 10 AS BIGINT) AS page_id,
    substr(CAST(ts AS VARCHAR), 1, 19) AS action_time,
    CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 6 AS VARCHAR)) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN CAST(1 + k % 20 AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS click_category_id,
    CASE WHEN event_type = 'click' THEN CAST(1 + k AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS click_product_id,
    CASE WHEN event_type = 'purchase' THEN cats END AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN cats END AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN cats END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN cats END AS pay_product_ids,
    CAST(1 + user_id % 26 AS BIGINT) AS city_id
  FROM ev2
)"""

_ADS = _BASE + """,
ads_log AS (
  SELECT e.event_id,
    epoch_us(e.ts) // 1000 AS ts_ms,
    replace(r.r_name, ' ', '_') AS province,
    n.n_name AS city,
    CAST(e.user_id AS VARCHAR) AS userid,
    CAST(1 + e.k % 10 AS VARCHAR) AS adid
  FROM ev e
  JOIN nation n ON n.n_nationkey = e.user_id % 25
  JOIN region r ON r.r_regionkey = n.n_regionkey
),
clicks AS (
  SELECT *, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day FROM ads_log
)"""

_OCC = """,
occ AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind
  FROM user_visit_action WHERE click_category_id IS NOT NULL AND click_category_id <> -1
  UNION ALL
  SELECT unnest(string_split(order_category_ids, ',')) AS category_id, 'order' AS kind
  FROM user_visit_action
  WHERE (click_category_id IS NULL OR click_category_id = -1) AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(string_split(pay_category_ids, ',')) AS category_id, 'pay' AS kind
  FROM user_visit_action
  WHERE (click_category_id IS NULL OR click_category_id = -1) AND order_category_ids IS NULL
    AND pay_category_ids IS NOT NULL
),
counts AS (
  SELECT category_id,
    CAST(SUM(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click_count,
    CAST(SUM(CASE WHEN kind = 'order' THEN 1 ELSE 0 END) AS BIGINT) AS order_count,
    CAST(SUM(CASE WHEN kind = 'pay' THEN 1 ELSE 0 END) AS BIGINT) AS pay_count
  FROM occ WHERE category_id <> '' GROUP BY category_id
),
top AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT """ + str(TOP_N) + """
)"""

_PAIRS = """,
pairs AS (
  SELECT session_id, action_time, page_id, next_page_id,
    concat(CAST(page_id AS VARCHAR), '-', CAST(next_page_id AS VARCHAR)) AS page_jump
  FROM (
    SELECT session_id, action_time, page_id,
      lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_page_id
    FROM user_visit_action
  ) WHERE next_page_id IS NOT NULL
),
jumps AS (
  SELECT page_id, page_jump, CAST(COUNT(*) AS BIGINT) AS jump_count FROM pairs
  WHERE page_jump IN (""" + ", ".join(
    f"'{a}-{b}'" for a, b in zip(TARGET_PAGES, TARGET_PAGES[1:])
) + """)
  GROUP BY page_id, page_jump
),
views AS (
  SELECT page_id, CAST(COUNT(*) AS BIGINT) AS view_count FROM user_visit_action
  WHERE page_id IN (""" + ", ".join(str(p) for p in TARGET_PAGES) + """)
  GROUP BY page_id
)"""

_PROVINCE = """,
pc AS (SELECT day, province, adid, COUNT(*) AS clicks FROM clicks GROUP BY day, province, adid),
pr AS (
  SELECT *, row_number() OVER (PARTITION BY day, province ORDER BY clicks DESC, adid) AS rk FROM pc
)"""

_TREND = f""",
fan AS (
  SELECT c.adid,
    c.ts_ms - c.ts_ms % {TREND_BUCKET_MS} AS bucket_ms,
    (c.ts_ms - c.ts_ms % {TREND_SLIDE_MS}) - j.range * {TREND_SLIDE_MS} AS ws
  FROM clicks c, range(0, {TREND_WINDOW_MS // TREND_SLIDE_MS}) j
  WHERE c.ts_ms < (c.ts_ms - c.ts_ms % {TREND_SLIDE_MS}) - j.range * {TREND_SLIDE_MS} + {TREND_WINDOW_MS}
),
trend AS (
  SELECT adid,
    strftime(make_timestamp(ws * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(make_timestamp((ws + {TREND_WINDOW_MS}) * 1000), '%Y-%m-%d %H:%M:%S') AS window_end,
    bucket_ms,
    strftime(make_timestamp(bucket_ms * 1000), '%H:%M:%S') AS bucket_time,
    CAST(COUNT(*) AS BIGINT) AS clicks
  FROM fan GROUP BY adid, ws, bucket_ms
)"""

_ARRIVAL = f""",
arrived AS (SELECT *, ts_ms + event_id % {ARRIVAL_STEPS} * {ARRIVAL_STEP_MS} AS arrival_ms FROM clicks),
fan AS (
  SELECT adid, ts_ms - ts_ms % {TREND_BUCKET_MS} AS bucket_ms, (arrival_ms - arrival_ms % {TREND_SLIDE_MS}) - j.range * {TREND_SLIDE_MS} AS ws
  FROM arrived, range(0, {TREND_WINDOW_MS // TREND_SLIDE_MS}) j
),""" + _TREND[_TREND.index("\ntrend AS"):]

_USER_AD = """,
uad AS (SELECT day, userid, adid, COUNT(*) AS clicks FROM clicks GROUP BY day, userid, adid)"""


def oracle_sql() -> dict[str, str]:
    found = _click_oracles()
    if corpus is not None:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _click_oracles() -> dict[str, str]:
    uva = "WITH " + _UVA
    ads = "WITH " + _ADS
    return {
        "action_range_scan": uva + f"""
SELECT * FROM user_visit_action
WHERE action_time >= '{RANGE_START}' AND action_time <= '{RANGE_END}'""",
        "category_action_counts": uva + _OCC + "\nSELECT * FROM counts",
        "category_top10": uva + _OCC + "\nSELECT * FROM top",
        "catalog_category_top10": uva.replace("user_visit_action AS", "whole_log AS") + f""",
user_visit_action AS (
  SELECT * FROM whole_log WHERE action_time >= '{RANGE_START}' AND action_time <= '{RANGE_END}'
)""" + _OCC + "\nSELECT * FROM top",
        "category_session_top10": uva + _OCC + f""",
cs AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, COUNT(*) AS click_count
  FROM user_visit_action
  WHERE click_category_id <> -1 AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top)
  GROUP BY 1, 2
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rk
  FROM cs
)
SELECT category_id, session_id, CAST(click_count AS BIGINT) AS click_count, CAST(rk AS BIGINT) AS "rank"
FROM ranked WHERE rk <= {SESSIONS_PER_CATEGORY}""",
        "session_page_pairs": uva + _PAIRS + "\nSELECT * FROM pairs",
        "page_jump_counts": uva + _PAIRS + "\nSELECT page_jump, jump_count FROM jumps",
        "page_view_counts": uva + _PAIRS + "\nSELECT * FROM views",
        "page_jump_rate": uva + _PAIRS + """
SELECT j.page_jump, j.jump_count, v.view_count,
  CAST(j.jump_count AS DOUBLE) / CAST(v.view_count AS DOUBLE) * 100 AS jump_rate
FROM jumps j JOIN views v ON j.page_id = v.page_id""",
        "ads_log_parse": ads + "\nSELECT " + ", ".join(CLICK_COLUMNS) + " FROM clicks",
        "ads_daily_clicks": ads + """
SELECT day, province, city, adid, COUNT(*) AS clicks FROM clicks GROUP BY day, province, city, adid""",
        "ads_province_top3": ads + _PROVINCE + f"""
SELECT day, province, adid, CAST(clicks AS BIGINT) AS clicks, CAST(rk AS BIGINT) AS "rank"
FROM pr WHERE rk <= {TOP_ADS}""",
        "ads_province_top3_json": ads + _PROVINCE + f"""
SELECT day, province,
  '{{' || string_agg('"' || adid || '":' || CAST(clicks AS VARCHAR), ',' ORDER BY rk) || '}}' AS top_ads_json
FROM pr WHERE rk <= {TOP_ADS} GROUP BY day, province""",
        "ads_click_trend": ads + _TREND + "\nSELECT * FROM trend",
        "ads_click_trend_json": ads + _TREND + """
SELECT adid, window_start, window_end,
  '{' || string_agg('"' || bucket_time || '":' || CAST(clicks AS VARCHAR), ',' ORDER BY bucket_ms) || '}' AS trend_json
FROM trend GROUP BY adid, window_start, window_end""",
        "ads_click_trend_arrival": ads + _ARRIVAL + "\nSELECT * FROM trend",
        "user_ad_daily_clicks": ads + _USER_AD + "\nSELECT * FROM uad",
        "blacklisted_users": ads + _USER_AD + f"\nSELECT DISTINCT userid FROM uad WHERE clicks > {THRESHOLD}",
        "accepted_clicks": ads + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY day, userid, adid ORDER BY ts_ms, event_id) AS n FROM clicks
),
bans AS (
  SELECT userid, ts_ms AS ban_ts, event_id AS ban_id FROM numbered WHERE n = {THRESHOLD + 1}
  QUALIFY row_number() OVER (PARTITION BY userid ORDER BY ts_ms, event_id) = 1
)
SELECT c.event_id, c.ts_ms, c.day, c.province, c.city, c.userid, c.adid
FROM clicks c LEFT JOIN bans b ON c.userid = b.userid
WHERE b.userid IS NULL OR c.ts_ms < b.ban_ts OR (c.ts_ms = b.ban_ts AND c.event_id <= b.ban_id)""",
    }
