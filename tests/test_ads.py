"""Ad-line parsing, labels, buckets and the ad jobs on hand-written rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickflow.functions.timefmt import bucket_start_ms, clock_label
from clickflow.operators import ad_click_trend, ad_click_trend_json, province_top_ads, province_top_ads_json
from clickflow.operators.ads import with_day
from clickflow.sources.adslog import parse_ad_lines

H = 3_600_000


def lines(spark, *ls):
    return spark.createDataFrame([(i, x) for i, x in enumerate(ls)], "event_id BIGINT, line STRING")


def clicks(spark, rows):
    """rows: (ts_ms, province, city, userid, adid)"""
    df = lines(spark, *[" ".join(str(x) for x in r) for r in rows])
    return with_day(parse_ad_lines(df, keep=["event_id"]))


def test_parse_fields_and_extras(spark):
    got = parse_ad_lines(lines(spark, "1543190400000 north beijing 7 3 extra")).collect()
    assert [(r.ts_ms, r.province, r.city, r.userid, r.adid) for r in got] == [(1543190400000, "north", "beijing", "7", "3")]


@pytest.mark.parametrize("bad", ["1 a b", "abc a b c d", "1 a  b c", "1 a b c "])
def test_malformed_lines_fail_or_drop(spark, bad):
    df = lines(spark, "5 a b c d", bad)
    assert parse_ad_lines(df, mode="drop").count() == 1
    with pytest.raises(PySparkException):
        parse_ad_lines(df, mode="fail").collect()


def test_clock_labels_are_24_hour_by_default(spark):
    df = spark.createDataFrame([(3_605_000,), (46_805_000,)], "ms BIGINT")
    assert [r.x for r in df.select(clock_label("ms").alias("x")).collect()] == ["01:00:05", "13:00:05"]
    assert {r.x for r in df.select(clock_label("ms", twelve_hour=True).alias("x")).collect()} == {"01:00:05"}


def test_bucket_edges(spark):
    df = spark.createDataFrame([(9_999,), (10_000,)], "ms BIGINT")
    assert [r.b for r in df.select(bucket_start_ms("ms", 10_000).alias("b")).collect()] == [0, 10_000]


def test_province_top_ads_rank_and_json(spark):
    rows = [(0, "P", "c", "u", a) for a in ["1", "2", "2", "3", "3", "3", "4", "4", "4"]]
    top = province_top_ads(clicks(spark, rows), 3)
    got = [(r.adid, r.clicks, r.rank) for r in top.orderBy("rank").collect()]
    assert got == [("3", 3, 1), ("4", 3, 2), ("2", 2, 3)]
    js = province_top_ads_json(top).collect()
    assert [(r.day, r.province, r.top_ads_json) for r in js] == [("1970-01-01", "P", '{"3":3,"4":3,"2":2}')]


def test_trend_windows_and_json(spark):
    # Reference sizes: 60 s window sliding 10 s, 10 s buckets.
    rows = [(9_999, "P", "c", "u", "1"), (10_000, "P", "c", "u", "1"), (15_000, "P", "c", "u", "1")]
    trend = ad_click_trend(clicks(spark, rows))
    got = {(r.window_start, r.bucket_time, r.clicks) for r in trend.collect()}
    # The 0 s bucket is in the 6 windows starting -50 s..0 s; the 10 s bucket in -40 s..10 s.
    assert len(got) == 12
    assert ("1970-01-01 00:00:00", "00:00:00", 1) in got and ("1970-01-01 00:00:00", "00:00:10", 2) in got
    js = {r.window_start: r.trend_json for r in ad_click_trend_json(trend).collect()}
    assert js["1970-01-01 00:00:00"] == '{"00:00:00":1,"00:00:10":2}'
    assert js["1970-01-01 00:00:10"] == '{"00:00:10":2}'


def test_trend_json_is_ordered_by_time_across_midnight(spark):
    base = 86_400_000 - 20 * 60_000  # 23:40
    rows = [(base + i * 600_000, "P", "c", "u", "1") for i in range(4)]  # 23:40 .. 00:10
    trend = ad_click_trend(clicks(spark, rows), H, 600_000, 600_000)
    js = {r.window_start: r.trend_json for r in ad_click_trend_json(trend).collect()}
    assert js["1970-01-01 23:30:00"] == '{"23:40:00":1,"23:50:00":1,"00:00:00":1,"00:10:00":1}'


@pytest.mark.parametrize("sizes", [(60_000, 10_000, 10_000), (H, 600_000, 600_000), (H, 600_000, 300_000),
                                   (60_000, 20_000, 10_000), (50_000, 20_000, 10_000), (60_000, 10_000, 20_000)])
def test_trend_fast_path_equals_spark_window(spark, sizes):
    import random
    rnd = random.Random(sum(sizes))
    rows = [(rnd.randint(0, 600_000), "P", "c", "u", str(rnd.randint(1, 3))) for _ in range(300)]
    df = clicks(spark, rows)
    w, s, b = sizes
    got = sorted(tuple(r) for r in ad_click_trend(df, w, s, b).drop("window_start_ms").collect())
    win = F.window("ts", f"{w} milliseconds", f"{s} milliseconds")
    ref = (
        df.withColumn("bucket_ms", F.col("ts_ms") - F.col("ts_ms") % b)
        .groupBy(win.alias("w"), "bucket_ms", "adid").count()
        .select("adid",
                F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("ws"),
                F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("we"),
                "bucket_ms", clock_label("bucket_ms").alias("bt"), "count")
    )
    assert got == sorted(tuple(r) for r in ref.collect())


def test_trend_rejects_windows_with_repeating_labels(spark):
    df = clicks(spark, [(0, "P", "c", "u", "1")])
    with pytest.raises(ValueError):
        ad_click_trend(df, 2 * 86_400_000, 86_400_000, 86_400_000)


@pytest.mark.parametrize("sizes", [(60_000, 10_000, 10_000), (50_000, 20_000, 10_000)])
def test_trend_windows_equal_json_of_rows(spark, sizes):
    import random
    from clickflow.operators import ad_click_trend_windows
    rnd = random.Random(3)
    df = clicks(spark, [(rnd.randint(0, 300_000), "P", "c", "u", str(rnd.randint(1, 3))) for _ in range(200)])
    a = sorted(tuple(r) for r in ad_click_trend_json(ad_click_trend(df, *sizes)).collect())
    b = sorted(tuple(r) for r in ad_click_trend_windows(df, *sizes).select("adid", "window_start", "window_end", "trend_json").collect())
    assert a == b


def test_drop_mode_counts_malformed_lines(spark):
    from pyspark.sql import Observation
    obs = Observation("ad_lines")
    df = parse_ad_lines(lines(spark, "5 a b c d", "1 a b", "x a b c d", "6 a b c d"), mode="drop", metrics=obs)
    assert df.count() == 2
    assert obs.get == {"lines": 4, "malformed": 2}
