"""Per-(day, user, ad) click totals, the user blacklist and the accepted clicks.

Semantics of the original stream, fixed at one-click granularity: every click of a
user counts until the user is banned; a ban happens when some (day, user, ad) total
goes strictly above ``threshold``, is permanent and covers all ads. The click that
crosses the threshold is itself accepted; later clicks of that user are dropped.
Because nothing is filtered before the first ban, the ban set is independent of
micro-batch boundaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.operators.ads import with_day

# The original job compared ``20 < count`` (its comments say 100).
DEFAULT_THRESHOLD = 20
MINUTE_MS = 60_000


def user_ad_daily_clicks(clicks: DataFrame) -> DataFrame:
    """(day, userid, adid, clicks)."""
    return with_day(clicks).groupBy("day", "userid", "adid").agg(F.count(F.lit(1)).alias("clicks"))


def over_threshold(totals: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """(userid) of every user with some total strictly above the threshold."""
    return totals.filter(F.col("clicks") > F.lit(threshold)).select("userid").distinct()


def blacklisted_users(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """(userid): the blacklist after all of ``clicks``."""
    return over_threshold(user_ad_daily_clicks(clicks), threshold)


def _order(clicks: DataFrame, tiebreak: str | None) -> list[str]:
    if tiebreak is None and "event_id" in clicks.columns:
        tiebreak = "event_id"
    return ["ts_ms"] + ([tiebreak] if tiebreak else [])


def first_bans(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD, tiebreak: str | None = None) -> DataFrame:
    """(userid, ban): ``ban`` is the (ts_ms, tiebreak) struct of the user's first click
    numbered above the threshold in its (day, user, ad) group.

    Clicks are counted per minute first, with partial aggregation. Minutes of groups above
    the threshold, summed up in order, tell the minute in which a group crosses it, and only
    that minute's clicks are numbered: a hot group ships one row per minute and map task, and
    costs one window row per minute of its day, whatever the threshold.
    """
    order = _order(clicks, tiebreak)
    key = ["day", "userid", "adid"]
    minute = F.floor(F.col("ts_ms") / F.lit(MINUTE_MS)).alias("_minute")
    dated = with_day(clicks).select(*key, *order, minute)
    minutes = dated.groupBy(*key, "_minute").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        minutes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter((F.col("_before") <= threshold) & (F.col("_before") + F.col("_n") > threshold))
        .select(*key, "_minute", "_before")
    )
    numbered = dated.join(crossing, [*key, "_minute"]).withColumn(
        "_at", F.col("_before") + F.row_number().over(Window.partitionBy(*key, "_minute").orderBy(*order))
    )
    nth = numbered.filter(F.col("_at") == threshold + 1)
    return nth.groupBy("userid").agg(F.min(F.struct(*order)).alias("ban"))


def accepted_clicks(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD, tiebreak: str | None = None) -> DataFrame:
    """Clicks kept by the blacklist filter, one-click granularity.

    The ban table has at most one row per user; its size is not bounded by a
    parameter, so no broadcast hint is given: AQE broadcasts it when the measured size
    is small and otherwise keeps a sort-merge join, splitting a hot user's partition.
    """
    order = _order(clicks, tiebreak)
    bans = first_bans(clicks, threshold, tiebreak)
    joined = clicks.join(bans, "userid", "left")
    keep = F.col("ban").isNull() | (F.struct(*order) <= F.col("ban"))
    return joined.filter(keep).drop("ban")
