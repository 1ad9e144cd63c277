"""Structured Streaming versions of the ad jobs.

Each job takes a parsed click stream (``sources.streams.ad_clicks_stream``) and writes
replay-safe keyed tables from ``foreachBatch``; the per-batch bodies call the same
DataFrame functions as the batch jobs.
"""

from clickflow.streaming.ads_streams import (
    BlacklistTables,
    TrendTables,
    start_blacklist,
    start_click_trend,
    start_daily_clicks,
    start_province_top_ads,
    stored_daily_clicks,
)

__all__ = [
    "BlacklistTables",
    "TrendTables",
    "start_blacklist",
    "start_click_trend",
    "start_daily_clicks",
    "start_province_top_ads",
    "stored_daily_clicks",
]
