"""J5-J7 on parsed ad clicks (ts_ms, ts, province, city, userid, adid).

Every function is ``DataFrame -> DataFrame`` and works on a batch or on one
micro-batch; the streaming module reuses them. Counts are partial+final hash
aggregates (a hot ad or province collapses map-side); rankings use ``row_number``
with a pushed-down group limit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.jsonfmt import ordered_json_object
from clickflow.functions.timefmt import bucket_start_ms, clock_label, day_label, stamp_label

# Fixed values of the original trend job: 60 s window sliding every 10 s, 10 s buckets.
REFERENCE_WINDOW_MS, REFERENCE_SLIDE_MS, REFERENCE_BUCKET_MS = 60_000, 10_000, 10_000
DAY_MS = 86_400_000


def with_day(clicks: DataFrame) -> DataFrame:
    """Add ``day`` (yyyy-MM-dd of ts_ms in the session zone) unless present."""
    return clicks if "day" in clicks.columns else clicks.withColumn("day", day_label("ts_ms"))


def ads_daily_clicks(clicks: DataFrame) -> DataFrame:
    """(day, province, city, adid, clicks)."""
    return (
        with_day(clicks)
        .groupBy("day", "province", "city", "adid")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )


def province_ad_clicks(clicks: DataFrame) -> DataFrame:
    """(day, province, adid, clicks)."""
    return (
        with_day(clicks)
        .groupBy("day", "province", "adid")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )


def rank_province_ads(counts: DataFrame, top_n: int = 3) -> DataFrame:
    """Top ``top_n`` ads per (day, province) from (day, province, adid, clicks).
    Ties go to the smaller adid (as a string)."""
    w = Window.partitionBy("day", "province").orderBy(F.col("clicks").desc(), F.col("adid").asc())
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= top_n)
        .select("day", "province", "adid", "clicks", F.col("rank").cast("bigint").alias("rank"))
    )


def province_top_ads(clicks: DataFrame, top_n: int = 3) -> DataFrame:
    """(day, province, adid, clicks, rank)."""
    return rank_province_ads(province_ad_clicks(clicks), top_n)


def province_top_ads_json(top: DataFrame) -> DataFrame:
    """J6 value: (day, province, top_ads_json) with ``{"adid":clicks,...}`` in rank order.

    ``top`` already holds at most top_n rows per group, so the list is bounded; it is
    partitioned by (day, province) by the ranking window, so this adds no shuffle.
    """
    entries = F.sort_array(F.collect_list(F.struct("rank", "adid", "clicks")))
    return top.groupBy("day", "province").agg(
        ordered_json_object(
            F.transform(entries, lambda e: F.struct(e["adid"], e["clicks"]))
        ).alias("top_ads_json")
    )


def _check_trend_sizes(window_ms: int, slide_ms: int, bucket_ms: int, twelve_hour: bool) -> None:
    if min(window_ms, slide_ms, bucket_ms) <= 0:
        raise ValueError("window, slide and bucket must be positive")
    # Clock labels repeat after 24 h (12 h for the original hh format); inside one
    # window they must be unique to serve as JSON keys.
    if window_ms > (DAY_MS // 2 if twelve_hour else DAY_MS):
        raise ValueError("clock labels repeat inside a window this long")


def _trend_counts(
    clicks: DataFrame, window_ms: int, slide_ms: int, bucket_ms: int, twelve_hour: bool
) -> DataFrame:
    """(adid, _ws, bucket_ms, bucket_time, clicks) with the numeric window start ``_ws``."""
    _check_trend_sizes(window_ms, slide_ms, bucket_ms, twelve_hour)
    with_bucket = clicks.select("adid", "ts", bucket_start_ms("ts_ms", bucket_ms).alias("bucket_ms"))
    if slide_ms % bucket_ms == 0 and window_ms % slide_ms == 0:
        per_bucket = with_bucket.groupBy("bucket_ms", "adid").agg(F.count(F.lit(1)).alias("clicks"))
        # Labels are formatted once per (bucket, ad), before the fan-out multiplies rows.
        last_start = F.col("bucket_ms") - F.pmod(F.col("bucket_ms"), F.lit(slide_ms))
        first_start = last_start - F.lit((window_ms // slide_ms - 1) * slide_ms)
        return per_bucket.select(
            "adid", "bucket_ms", clock_label("bucket_ms", twelve_hour).alias("bucket_time"), "clicks",
        ).select(
            "adid", "bucket_ms", "bucket_time", "clicks",
            F.explode(F.sequence(first_start, last_start, F.lit(slide_ms).cast("bigint"))).alias("_ws"),
        )
    win = F.window("ts", f"{window_ms} milliseconds", f"{slide_ms} milliseconds")
    return (
        with_bucket.groupBy(win.alias("w"), "bucket_ms", "adid")
        .agg(F.count(F.lit(1)).alias("clicks"))
        .select(
            "adid", "bucket_ms", clock_label("bucket_ms", twelve_hour).alias("bucket_time"), "clicks",
            F.unix_millis(F.col("w.start")).alias("_ws"),
        )
    )


def ad_click_trend(
    clicks: DataFrame,
    window_ms: int = REFERENCE_WINDOW_MS,
    slide_ms: int = REFERENCE_SLIDE_MS,
    bucket_ms: int = REFERENCE_BUCKET_MS,
    twelve_hour: bool = False,
) -> DataFrame:
    """Clicks per ad per bucket inside every sliding window, by event time.

    Output (adid, window_start_ms, window_start, window_end, bucket_ms, bucket_time,
    clicks); ``window_start_ms`` (epoch ms) identifies the window, its bounds are
    ``yyyy-MM-dd HH:mm:ss`` labels, ``bucket_ms`` the bucket start (epoch ms),
    ``bucket_time`` its ``HH:mm:ss`` label. Windows are ``[start, start+window)``
    aligned to the epoch, as Spark's ``window()``.

    When the bucket divides the slide and the slide divides the window (the usual
    case, and the original 60 s / 10 s / 10 s), all clicks of a bucket fall into the
    same windows, so clicks are first counted per (bucket, ad) and only those counts
    are fanned out to the ``window/slide`` windows: the fan-out touches aggregated
    rows, not raw clicks. Otherwise Spark's ``window()`` expands raw rows.
    """
    counts = _trend_counts(clicks, window_ms, slide_ms, bucket_ms, twelve_hour)
    return counts.select(
        "adid",
        F.col("_ws").alias("window_start_ms"),
        stamp_label(F.col("_ws")).alias("window_start"),
        stamp_label(F.col("_ws") + F.lit(window_ms)).alias("window_end"),
        "bucket_ms",
        "bucket_time",
        "clicks",
    )


def ad_click_trend_by_arrival(
    clicks: DataFrame,
    window_ms: int = REFERENCE_WINDOW_MS,
    slide_ms: int = REFERENCE_SLIDE_MS,
    bucket_ms: int = REFERENCE_BUCKET_MS,
    twelve_hour: bool = False,
    arrival: str = "arrival_ms",
) -> DataFrame:
    """J7 as the original job windowed it: windows over the arrival stamps (epoch ms) of
    column ``arrival``, buckets by event time. Same columns as ``ad_click_trend``; the first
    and last windows, which hold part of a window of arrivals, are included.

    Clicks are counted per (ad, bucket, slot of arrivals) first; a slot is the greatest length
    that divides window and slide, so only counts are fanned out to windows and summed again.
    """
    _check_trend_sizes(window_ms, slide_ms, bucket_ms, twelve_hour)
    slot = math.gcd(window_ms, slide_ms)
    counts = clicks.groupBy(
        "adid", bucket_start_ms("ts_ms", bucket_ms).alias("bucket_ms"), bucket_start_ms(arrival, slot).alias("_slot")
    ).agg(F.count(F.lit(1)).alias("clicks"))
    last = F.col("_slot") - F.pmod(F.col("_slot"), F.lit(slide_ms))
    first = last - F.lit((window_ms - 1) // slide_ms * slide_ms)
    fanned = counts.withColumn("window_start_ms", F.explode(F.sequence(first, last, F.lit(slide_ms).cast("bigint"))))
    fanned = fanned.filter(F.col("_slot") < F.col("window_start_ms") + F.lit(window_ms))
    return fanned.groupBy("adid", "window_start_ms", "bucket_ms").agg(F.sum("clicks").alias("clicks")).select(
        "adid", "window_start_ms", stamp_label("window_start_ms").alias("window_start"),
        stamp_label(F.col("window_start_ms") + F.lit(window_ms)).alias("window_end"),
        "bucket_ms", clock_label("bucket_ms", twelve_hour).alias("bucket_time"), "clicks",
    )


def ad_click_trend_windows(
    clicks: DataFrame,
    window_ms: int = REFERENCE_WINDOW_MS,
    slide_ms: int = REFERENCE_SLIDE_MS,
    bucket_ms: int = REFERENCE_BUCKET_MS,
    twelve_hour: bool = False,
) -> DataFrame:
    """J7 value straight from clicks: (adid, window_start, window_end, trend_json).

    Same result as ``ad_click_trend_json(ad_click_trend(...))``, but the rows are
    grouped on the numeric window start and the window labels are formatted once per
    (ad, window) instead of once per bucket row.
    """
    counts = _trend_counts(clicks, window_ms, slide_ms, bucket_ms, twelve_hour)
    entries = F.sort_array(F.collect_list(F.struct("bucket_ms", "bucket_time", "clicks")))
    per_window = counts.groupBy("adid", "_ws").agg(
        ordered_json_object(F.transform(entries, lambda e: F.struct(e["bucket_time"], e["clicks"]))).alias("trend_json")
    )
    return per_window.select(
        "adid",
        stamp_label(F.col("_ws")).alias("window_start"),
        stamp_label(F.col("_ws") + F.lit(window_ms)).alias("window_end"),
        "trend_json",
    )


def ad_click_trend_json(trend: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """J7 value: (adid, window_start, window_end, trend_json) with
    ``{"HH:mm:ss":clicks,...}`` ordered by bucket time (not by label). Windows are told
    apart by ``window_start_ms``; ``keep`` names further columns of a window. A window holds at most window/bucket entries, so the
    collected list is bounded."""
    entries = F.sort_array(F.collect_list(F.struct("bucket_ms", "bucket_time", "clicks")))
    return (
        trend.groupBy(*dict.fromkeys(["adid", "window_start_ms", "window_start", "window_end", *(keep or [])]))
        .agg(
            ordered_json_object(
                F.transform(entries, lambda e: F.struct(e["bucket_time"], e["clicks"]))
            ).alias("trend_json")
        )
        .drop(*[c for c in ("window_start_ms",) if c not in (keep or [])])
    )
