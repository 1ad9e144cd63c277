"""Views of the shared test tables in the click-log and ad-log models.

The test data has no click log. ``events`` is mapped onto ``user_visit_action`` and
``ads_log`` with fixed expressions (FIXTURES.md section 2); the same expressions are
written in DuckDB SQL for the oracle, so both engines see identical rows. ``event_id``
is carried as the tie-break column. The projections are SQL expression strings: one
``selectExpr`` is parsed JVM-side in a single call instead of hundreds of Python ->
JVM round trips for a Column tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.schemas import SOURCE_TABLES

# Fixed values of the mapping (must equal the oracle's): k is the first integer in
# ``props``; pages 1..10, categories 1..20, keywords kw0..kw5, cities 1..26, ads 1..10,
# provinces are region names with spaces replaced by underscores.
_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k"
_CATS = (
    "concat(CAST(1 + k % 20 AS STRING),"
    " CASE WHEN k % 3 >= 1 THEN concat(',', CAST(1 + (k * 7) % 20 AS STRING)) ELSE '' END,"
    " CASE WHEN k % 3 = 2 THEN concat(',', CAST(1 + (k * 3) % 20 AS STRING)) ELSE '' END) AS cats"
)
_UVA = [
    "event_id",
    "substr(ts_s, 1, 10) AS date",
    "CAST(user_id AS BIGINT) AS user_id",
    "concat(CAST(user_id AS STRING), '-', substr(ts_s, 1, 7)) AS session_id",
    "CAST(1 + k % 10 AS BIGINT) AS page_id",
    "substr(ts_s, 1, 19) AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 6 AS STRING)) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN CAST(1 + k % 20 AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN CAST(1 + k AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS click_product_id",
    "CASE WHEN event_type = 'purchase' THEN cats END AS order_category_ids",
    "CASE WHEN event_type = 'purchase' THEN cats END AS order_product_ids",
    "CASE WHEN event_type = 'signup' THEN cats END AS pay_category_ids",
    "CASE WHEN event_type = 'signup' THEN cats END AS pay_product_ids",
    "CAST(1 + user_id % 26 AS BIGINT) AS city_id",
]
_ADS = [
    "event_id",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS ts_ms",
    "province",
    "city",
    "CAST(user_id AS STRING) AS userid",
    "CAST(1 + k % 10 AS STRING) AS adid",
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_visit_action`` rows (plus ``event_id``) derived from ``events``."""
    ev = _read(spark, sf_dir, "events")
    with_k = ev.selectExpr("event_id", "user_id", "event_type", "CAST(ts AS STRING) AS ts_s", _K)
    return with_k.selectExpr("*", _CATS).selectExpr(*_UVA)


def fixture_ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks (event_id, ts_ms, province, city, userid, adid) derived from events.

    ``nation`` and ``region`` are fixed 25- and 5-row dimensions; the planner broadcasts
    them from their measured file size, no hint needed. ``ts`` is a TIMESTAMP_NTZ and is
    read as UTC wall-clock time: fixture queries pin the session zone to UTC.
    """
    ev = _read(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", _K)
    # Dimension attributes are derived on the dimension rows, before the join.
    nation = _read(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name AS city", "n_regionkey")
    region = _read(spark, sf_dir, "region").selectExpr("r_regionkey", "regexp_replace(r_name, ' ', '_') AS province")
    joined = ev.join(nation, ev["user_id"] % 25 == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    return joined.selectExpr(*_ADS)


def fixture_ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad clicks as wire lines, with ``event_id`` alongside (like a source offset)."""
    return fixture_ads_log(spark, sf_dir).selectExpr(
        "event_id", "concat_ws(' ', CAST(ts_ms AS STRING), province, city, userid, adid) AS line"
    )


def fixture_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed ad clicks of ``fixture_ads_log`` with the event time ``ts`` added: the
    shape ``parse_ad_lines`` produces, without the wire-line round trip (the line
    format is exercised by the parse query and the stream tests)."""
    return fixture_ads_log(spark, sf_dir).selectExpr("*", "timestamp_millis(ts_ms) AS ts")
