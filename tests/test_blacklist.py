"""J4 batch semantics."""

from clickflow.operators import accepted_clicks, blacklisted_users
from clickflow.operators.ads import with_day
from clickflow.sources.adslog import parse_ad_lines

DAY = 86_400_000


def clicks(spark, rows):
    """rows: (ts_ms, userid, adid) in arrival order."""
    df = spark.createDataFrame(
        [(i, f"{t} P c {u} {a}") for i, (t, u, a) in enumerate(rows)], "event_id BIGINT, line STRING"
    )
    return with_day(parse_ad_lines(df, keep=["event_id"]))


def test_threshold_is_strict(spark):
    at = clicks(spark, [(i, "u", "1") for i in range(3)])
    above = clicks(spark, [(i, "u", "1") for i in range(4)])
    assert blacklisted_users(at, 3).count() == 0
    assert [r.userid for r in blacklisted_users(above, 3).collect()] == ["u"]


def test_counts_are_per_day_and_ad(spark):
    rows = [(i, "u", str(1 + i % 2)) for i in range(6)] + [(DAY + i, "u", "1") for i in range(3)]
    assert blacklisted_users(clicks(spark, rows), 3).count() == 0


def test_ban_covers_later_clicks_on_other_ads_and_days(spark):
    rows = [(i, "u", "1") for i in range(4)]  # 4th click crosses threshold 3
    rows += [(10, "u", "2"), (DAY + 5, "u", "2"), (11, "v", "1")]
    got = sorted((r.userid, r.ts_ms) for r in accepted_clicks(clicks(spark, rows), 3).collect())
    assert got == [("u", 0), ("u", 1), ("u", 2), ("u", 3), ("v", 11)]


def test_same_millisecond_ordered_by_tiebreak(spark):
    rows = [(5, "u", "1")] * 3 + [(5, "u", "2")]
    got = sorted(r.event_id for r in accepted_clicks(clicks(spark, rows), 2).collect())
    assert got == [0, 1, 2]
