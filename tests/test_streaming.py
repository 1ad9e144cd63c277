"""Streams (file source, availableNow) against the batch jobs on the same input."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from clickflow.operators import (
    accepted_clicks,
    ad_click_trend,
    ad_click_trend_json,
    ads_daily_clicks,
    blacklisted_users,
    province_top_ads,
    province_top_ads_json,
)
from clickflow.sources.streams import ad_clicks_stream, read_ad_lines_stream
from clickflow.streaming import start_blacklist, start_click_trend, start_daily_clicks, start_province_top_ads
from clickflow.streaming.ads_streams import BlacklistTables, blacklist_body
from clickflow.sinks.keyed import KeyedTable

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def fixture_lines(spark):
    """All fixture ad lines (event_id, line) in arrival order."""
    E._utc(spark)
    df = E.fixture_ad_lines(spark, SF)
    pdf = df.toPandas()
    pdf["ts"] = pdf["line"].str.split(" ").str[0].astype("int64")
    return pdf.sort_values(["ts", "event_id"]).drop(columns="ts").reset_index(drop=True)


def write_files(pdf, n_files, directory):
    os.makedirs(directory, exist_ok=True)
    size = -(-len(pdf) // n_files)
    for i in range(n_files):
        part = pdf.iloc[i * size:(i + 1) * size]
        path = f"{directory}/part-{i:04d}.parquet"
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return directory


def stream_of(spark, directory, metrics=None):
    lines = read_ad_lines_stream(spark, "parquet", directory, schema="event_id BIGINT, line STRING", max_per_trigger=1)
    return ad_clicks_stream(lines, metrics=metrics)


def rows(df, cols=None):
    df = df.select(*(cols or sorted(df.columns)))
    return sorted(tuple(r) for r in df.collect())


def batch_clicks(spark, pdf):
    from clickflow.operators.ads import with_day
    from clickflow.sources.adslog import parse_ad_lines
    return with_day(parse_ad_lines(spark.createDataFrame(pdf, "event_id BIGINT, line STRING"), keep=["event_id"]))


@pytest.fixture(scope="module")
def late_lines(fixture_lines):
    """The clicks in shuffled order, days late against each other, after one far-future line."""
    import pandas as pd
    future = pd.DataFrame({"event_id": [10**9], "line": ["250000000000000 Asia c u 1"]})
    return pd.concat([future, fixture_lines.sample(frac=1, random_state=4)], ignore_index=True)


def test_daily_clicks_count_late_clicks(spark, late_lines, tmpdir_):
    src = write_files(late_lines, 4, f"{tmpdir_}/in")
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, late_lines)))


def test_province_top_counts_late_clicks(spark, late_lines, tmpdir_):
    src = write_files(late_lines, 4, f"{tmpdir_}/in")
    q, top = start_province_top_ads(stream_of(spark, src), f"{tmpdir_}/counts", f"{tmpdir_}/top", 3,
                                    trigger=NOW, checkpoint=f"{tmpdir_}/cp", compact_every=2)
    q.awaitTermination()
    expect = province_top_ads_json(province_top_ads(batch_clicks(spark, late_lines), 3))
    assert rows(top.current(spark)) == rows(expect)


def test_click_trend_counts_late_clicks(spark, late_lines, tmpdir_):
    src = write_files(late_lines, 4, f"{tmpdir_}/in")
    q, t = start_click_trend(stream_of(spark, src), f"{tmpdir_}/trend", 3_600_000, 600_000, 600_000,
                             trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    trend = ad_click_trend(batch_clicks(spark, late_lines), 3_600_000, 600_000, 600_000)
    cols = ["adid", "window_start", "window_end", "trend_json"]
    assert rows(t.windows.current(spark), cols) == rows(ad_click_trend_json(trend), cols)
    newest = {}
    for adid, ws in {(r.adid, r.window_start_ms) for r in trend.collect()}:
        newest[adid] = max(newest.get(adid, ws), ws)
    assert {r.adid: r.window_start_ms for r in t.latest.current(spark).collect()} == newest


@pytest.mark.parametrize("sizes", [(60_000, 10_000, 10_000), (7_200_000, 1_800_000, 1_800_000)])
def test_trend_across_the_end_of_daylight_saving(spark, tmpdir_, sizes):
    import datetime as dt

    import pandas as pd

    from clickflow.operators import ad_click_trend_windows
    start = int(dt.datetime(2024, 11, 3, 4, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    pdf = pd.DataFrame({"event_id": range(48), "line": [f"{start + i * 300_000} P c u 1" for i in range(48)]})
    src = write_files(pdf, 3, f"{tmpdir_}/in")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        clicks = batch_clicks(spark, pdf)
        cols = ["adid", "window_start", "window_end", "trend_json"]
        direct = rows(ad_click_trend_windows(clicks, *sizes), cols)
        assert direct == rows(ad_click_trend_json(ad_click_trend(clicks, *sizes)), cols)
        q, t = start_click_trend(stream_of(spark, src), f"{tmpdir_}/trend", *sizes, trigger=NOW, checkpoint=f"{tmpdir_}/cp")
        q.awaitTermination()
        assert rows(t.windows.current(spark), cols) == direct
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    import json
    total = sum(sum(json.loads(r[3]).values()) for r in direct)
    assert total == 48 * (sizes[0] // sizes[1])


@pytest.mark.parametrize("n_files,state", [(1, "deltas"), (4, "deltas"), (4, "store")])
def test_daily_clicks_stream_equals_batch(spark, fixture_lines, tmpdir_, n_files, state):
    src = write_files(fixture_lines, n_files, f"{tmpdir_}/in")
    q, table = start_daily_clicks(stream_of(spark, src, metrics="ad_lines"), f"{tmpdir_}/out", trigger=NOW,
                                  checkpoint=f"{tmpdir_}/cp", compact_every=2, state=state)
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))
    seen = sum(p["observedMetrics"]["ad_lines"]["lines"] for p in q.recentProgress if "ad_lines" in p.get("observedMetrics", {}))
    assert seen == len(fixture_lines)


def test_daily_clicks_restart_from_checkpoint(spark, fixture_lines, tmpdir_):
    half = len(fixture_lines) // 2
    src = f"{tmpdir_}/in"
    write_files(fixture_lines.iloc[:half], 2, src)
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    rest = fixture_lines.iloc[half:].reset_index(drop=True)
    os.makedirs(f"{tmpdir_}/tmp2")
    write_files(rest, 2, f"{tmpdir_}/tmp2")
    for i, f in enumerate(sorted(os.listdir(f"{tmpdir_}/tmp2"))):
        os.replace(f"{tmpdir_}/tmp2/{f}", f"{src}/late-{i}.parquet")
        os.utime(f"{src}/late-{i}.parquet", (1_800_000_000 + i, 1_800_000_000 + i))
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))


@pytest.mark.parametrize("n_files", [1, 3])
def test_province_top_stream_equals_batch(spark, fixture_lines, tmpdir_, n_files):
    src = write_files(fixture_lines, n_files, f"{tmpdir_}/in")
    q, top = start_province_top_ads(stream_of(spark, src), f"{tmpdir_}/counts", f"{tmpdir_}/top", 3,
                                    trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    expect = province_top_ads_json(province_top_ads(batch_clicks(spark, fixture_lines), 3))
    assert rows(top.current(spark)) == rows(expect)


def test_province_top_batch_scope_ranks_each_batch(spark, fixture_lines, tmpdir_):
    src = write_files(fixture_lines, 1, f"{tmpdir_}/in")
    q, top = start_province_top_ads(stream_of(spark, src), None, f"{tmpdir_}/top", 3, scope="batch",
                                    trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    expect = province_top_ads_json(province_top_ads(batch_clicks(spark, fixture_lines), 3))
    assert rows(top.current(spark)) == rows(expect)


@pytest.mark.parametrize("sizes", [
    (E.TREND_WINDOW_MS, E.TREND_SLIDE_MS, E.TREND_BUCKET_MS),
    (60_000, 10_000, 10_000),  # the original sizes
    (3_000_000, 1_200_000, 600_000),  # slide does not divide window: raw-row window() path
])
def test_click_trend_stream_equals_batch(spark, fixture_lines, tmpdir_, sizes):
    src = write_files(fixture_lines, 3, f"{tmpdir_}/in")
    w, s, b = sizes
    q, t = start_click_trend(stream_of(spark, src), f"{tmpdir_}/trend", w, s, b, trigger=NOW,
                             checkpoint=f"{tmpdir_}/cp", compact_every=2)
    q.awaitTermination()
    clicks = batch_clicks(spark, fixture_lines)
    trend = ad_click_trend(clicks, w, s, b)
    cols = ["adid", "window_start", "window_end", "bucket_ms", "bucket_time", "clicks"]
    got_rows = rows(t.rows.current(spark), cols)
    got_windows = {(r[0], r[1]) for r in got_rows}  # (adid, window_start)
    assert got_rows == rows(trend, cols)
    jcols = ["adid", "window_start", "window_end", "trend_json"]
    js = rows(t.windows.current(spark), jcols)
    assert js == rows(ad_click_trend_json(trend), jcols)
    latest = {r.adid: r.window_start for r in t.latest.current(spark).collect()}
    newest = {}
    for adid, ws in got_windows:
        newest[adid] = max(newest.get(adid, ws), ws)
    assert latest == newest


@pytest.mark.parametrize("n_files", [1, 4])
def test_blacklist_stream(spark, fixture_lines, tmpdir_, n_files):
    src = write_files(fixture_lines, n_files, f"{tmpdir_}/in")
    q, t = start_blacklist(stream_of(spark, src), f"{tmpdir_}/bl", threshold=E.THRESHOLD, trigger=NOW,
                           checkpoint=f"{tmpdir_}/cp", compact_every=2)
    q.awaitTermination()
    clicks = batch_clicks(spark, fixture_lines)
    assert rows(t.bans.current(spark)) == rows(blacklisted_users(clicks, E.THRESHOLD))
    got = {r.event_id for r in t.accepted.current(spark).collect()}
    exact = {r.event_id for r in accepted_clicks(clicks, E.THRESHOLD).collect()}
    assert exact <= got
    if n_files == 1:
        assert len(got) == len(fixture_lines)


def test_blacklist_replayed_batch_changes_nothing(spark, fixture_lines, tmpdir_):
    root = f"{tmpdir_}/bl"
    counts = KeyedTable(f"{root}/counts", "day STRING, userid STRING, adid STRING, clicks BIGINT",
                        ["day", "userid", "adid"], "sum", compact_every=2, partition_by="day")
    bans = KeyedTable(f"{root}/bans", "userid STRING", ["userid"], "set", compact_every=2)
    clicks = batch_clicks(spark, fixture_lines)
    cols = [c for c in clicks.columns if c != "ts"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in clicks.schema.fields if f.name != "ts")
    acc = KeyedTable(f"{root}/acc", schema, cols, "append")
    tables = BlacklistTables(counts, bans, acc)
    for tb in (counts, bans, acc):
        tb.ensure(spark)
    body = blacklist_body(tables, E.THRESHOLD, cols)
    k = 4
    size = -(-len(fixture_lines) // k)
    parts = [batch_clicks(spark, fixture_lines.iloc[i * size:(i + 1) * size]) for i in range(k)]
    states = []
    for n, part in enumerate(parts):
        body(part, n)
        states.append((rows(bans.current(spark)), rows(counts.current(spark)), rows(acc.current(spark))))
    body(parts[2], 2)
    body(parts[3], 3)
    assert (rows(bans.current(spark)), rows(counts.current(spark)), rows(acc.current(spark))) == states[-1]


def test_console_preview_runs(spark, fixture_lines, tmpdir_, capfd):
    from clickflow.streaming.ads_streams import start_console_preview
    src = write_files(fixture_lines.iloc[:5], 1, f"{tmpdir_}/in")
    q = start_console_preview(stream_of(spark, src).select("userid", "adid"), trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None


def test_daily_clicks_stream_in_a_non_utc_zone(spark, fixture_lines, tmpdir_):
    src = write_files(fixture_lines, 2, f"{tmpdir_}/in")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
        q.awaitTermination()
        got = rows(table.current(spark))
        expect = rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expect
    # Labels really are local days: some differ from the UTC labels.
    utc = rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))
    assert got != utc


def test_province_top_replayed_batch_changes_nothing(spark, fixture_lines, tmpdir_):
    from clickflow.streaming.ads_streams import province_top_body
    counts = KeyedTable(f"{tmpdir_}/counts", "day STRING, province STRING, adid STRING, clicks BIGINT",
                        ["day", "province", "adid"], "sum", compact_every=2, partition_by="day")
    top = KeyedTable(f"{tmpdir_}/top", "day STRING, province STRING, top_ads_json STRING",
                     ["day", "province"], "latest", compact_every=2)
    for t in (counts, top):
        t.ensure(spark)
    body = province_top_body(counts, top, 3)
    k = 3
    size = -(-len(fixture_lines) // k)
    batches = [batch_clicks(spark, fixture_lines.iloc[i * size:(i + 1) * size]) for i in range(k)]
    for n, b in enumerate(batches):
        body(b, n)
    state = rows(top.current(spark))
    body(batches[2], 2)
    assert rows(top.current(spark)) == state
    expect = province_top_ads_json(province_top_ads(batch_clicks(spark, fixture_lines), 3))
    assert state == rows(expect)


def test_daily_clicks_complete_mode(spark, fixture_lines, tmpdir_):
    src = write_files(fixture_lines, 3, f"{tmpdir_}/in")
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW,
                                  checkpoint=f"{tmpdir_}/cp", state="store", output_mode="complete")
    q.awaitTermination()
    expect = rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))
    assert rows(table.current(spark)) == expect
    last = max(p["batchId"] for p in q.recentProgress)
    assert rows(table.batch(spark, last)) == expect  # every key re-written in the last batch


def test_daily_clicks_stream_across_daylight_saving_days(spark, tmpdir_):
    import datetime as dt

    import pandas as pd
    stamps = []
    for day in (dt.date(2024, 3, 9), dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2024, 11, 4)):
        for h in range(0, 24, 2):
            t = dt.datetime(day.year, day.month, day.day, h, 30, tzinfo=dt.timezone.utc)
            stamps.append(int(t.timestamp() * 1000))
    pdf = pd.DataFrame({"event_id": range(len(stamps)), "line": [f"{t} P c u 1" for t in stamps]})
    src = write_files(pdf, 2, f"{tmpdir_}/in")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
        q.awaitTermination()
        got = rows(table.current(spark))
        expect = rows(ads_daily_clicks(batch_clicks(spark, pdf)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expect


def test_daily_clicks_delta_variant(spark, fixture_lines, tmpdir_):
    src = write_files(fixture_lines, 3, f"{tmpdir_}/in")
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW,
                                  checkpoint=f"{tmpdir_}/cp", state="deltas", compact_every=2)
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))


def test_text_line_source(spark, fixture_lines, tmpdir_):
    import os
    os.makedirs(f"{tmpdir_}/txt")
    with open(f"{tmpdir_}/txt/part-0.txt", "w") as f:
        f.write("\n".join(fixture_lines["line"]) + "\n")
    lines = read_ad_lines_stream(spark, "text", f"{tmpdir_}/txt")
    q, table = start_daily_clicks(ad_clicks_stream(lines), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp")
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, fixture_lines)))


def test_kafka_source_explains_missing_package(spark):
    with pytest.raises(ValueError):
        read_ad_lines_stream(spark, "kafka")
    try:
        read_ad_lines_stream(spark, "kafka", bootstrap_servers="localhost:9092")
    except RuntimeError as e:  # no Kafka package in this environment
        assert "spark-sql-kafka-0-10" in str(e)
