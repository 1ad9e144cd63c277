"""Declared schemas. Nothing is inferred at run time."""

from pyspark.sql import types as T

# One row per user action in the click log (table ``user_visit_action``).
# Sentinels: click ids are -1 when the row is not a click; the comma lists are null
# when the row is not an order / a payment. ``date`` and ``action_time`` are strings
# (``yyyy-MM-dd`` and ``yyyy-MM-dd HH:mm:ss``) and compare as strings.
USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

# Source tables of the shared test data, declared so that scans never infer a schema
# from file footers (one footer read per query here, a full listing at scale).
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
NATION = T.StructType(
    [
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]
)
REGION = T.StructType(
    [
        T.StructField("r_regionkey", T.IntegerType()),
        T.StructField("r_name", T.StringType()),
    ]
)
SOURCE_TABLES = {"events": EVENTS, "nation": NATION, "region": REGION}
