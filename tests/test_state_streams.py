"""Streams with keyed state in the store: bans at click granularity, trend rings, windows by arrival."""

import os
import time

import pandas as pd
import pytest

import __spark_entry__ as E
from clickflow.operators import accepted_clicks, ad_click_trend, ad_click_trend_by_arrival, ad_click_trend_json, blacklisted_users
from clickflow.sources.streams import ad_clicks_stream, read_ad_lines_stream
from clickflow.streaming import start_blacklist, start_click_trend
from tests.test_streaming import NOW, batch_clicks, fixture_lines, late_lines, rows, stream_of, write_files  # noqa: F401

HOUR, TEN = 3_600_000, 600_000


def _more_files(pdf, n_files, directory, scratch):
    """Further files of a stream's folder, younger than those there."""
    write_files(pdf, n_files, scratch)
    for i, name in enumerate(sorted(os.listdir(scratch))):
        os.replace(f"{scratch}/{name}", f"{directory}/later-{i}.parquet")
        os.utime(f"{directory}/later-{i}.parquet", (1_800_000_000 + i, 1_800_000_000 + i))


def test_bans_act_at_the_click_across_a_restart(spark, fixture_lines, tmpdir_):  # noqa: F811
    half = len(fixture_lines) // 2
    src = write_files(fixture_lines.iloc[:half], 2, f"{tmpdir_}/in")
    for part in (None, fixture_lines.iloc[half:]):
        if part is not None:
            _more_files(part, 2, src, f"{tmpdir_}/tmp")
        q, t = start_blacklist(stream_of(spark, src), f"{tmpdir_}/bl", threshold=E.THRESHOLD, trigger=NOW,
                               checkpoint=f"{tmpdir_}/cp", state="store")
        q.awaitTermination()
    clicks = batch_clicks(spark, fixture_lines)
    assert rows(t.bans.current(spark)) == rows(blacklisted_users(clicks, E.THRESHOLD))
    exact = accepted_clicks(clicks, E.THRESHOLD).drop("ts")
    assert rows(t.accepted.current(spark).drop("bans", "batch_id"), sorted(exact.columns)) == rows(exact)
    # A batch updates the state of its own users' groups, fewer than the stream has seen.
    last = [p for p in q.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]
    assert 0 < last["numRowsUpdated"] < last["numRowsTotal"]


@pytest.mark.parametrize("sizes", [(3_000_000, 1_200_000, 600_000)])
def test_rings_equal_the_batch_job_on_shuffled_clicks(spark, late_lines, tmpdir_, sizes):  # noqa: F811
    src = write_files(late_lines, 4, f"{tmpdir_}/in")
    q, t = start_click_trend(stream_of(spark, src), f"{tmpdir_}/trend", *sizes, trigger=NOW, checkpoint=f"{tmpdir_}/cp",
                             state="store", compact_every=2)
    q.awaitTermination()
    trend = ad_click_trend(batch_clicks(spark, late_lines), *sizes)
    cols = ["adid", "window_start_ms", "window_start", "window_end", "bucket_ms", "bucket_time", "clicks"]
    assert rows(t.rows.current(spark), cols) == rows(trend, cols)
    cols = ["adid", "window_start", "window_end", "trend_json"]
    assert rows(t.windows.current(spark), cols) == rows(ad_click_trend_json(trend), cols)


def _arrivals(n):
    """Lines with rising arrival stamps, behind their event times by up to an hour."""
    start = 1_700_000_000_000
    out, at = [], start
    for i in range(n):
        at += 30_000 + (i * 7919) % 400_000
        out.append((i, f"{at - (i * 104_729) % HOUR} Asia c u {i % 3}", at))
    return pd.DataFrame(out, columns=["event_id", "line", "arrival_ms"])


def _brute_by_arrival(pdf, window, slide, bucket):
    out = {}
    for line, at in zip(pdf["line"], pdf["arrival_ms"]):
        ts, ad = int(line.split(" ")[0]), line.split(" ")[4]
        start = at - at % slide
        while start > at - window:
            key = (ad, start, ts - ts % bucket)
            out[key] = out.get(key, 0) + 1
            start -= slide
    return sorted((*k, n) for k, n in out.items())


def _arrival_stream(spark, src):
    schema = "event_id BIGINT, line STRING, arrival_ms BIGINT"
    return ad_clicks_stream(read_ad_lines_stream(spark, "parquet", src, schema=schema, max_per_trigger=1))


def _by_arrival(spark, src, folder, sizes, idle_ms):
    # A query with timers never runs out of batches, so it is stopped, not awaited.
    return start_click_trend(_arrival_stream(spark, src), f"{folder}/trend", *sizes, trigger={"processingTime": "1 second"},
                             checkpoint=f"{folder}/cp", state="store", by="arrival_ms", idle_ms=idle_ms)


def _until(query, done, seconds=90):
    try:
        end = time.time() + seconds
        while not done():
            assert query.exception() is None and time.time() < end
            time.sleep(1)
    finally:
        query.stop()


@pytest.mark.parametrize("sizes", [(1_500_000, TEN, 60_000)])
def test_windows_by_arrival(spark, tmpdir_, sizes):
    pdf = _arrivals(300)
    want = _brute_by_arrival(pdf, *sizes)
    cols = ["adid", "window_start_ms", "bucket_ms", "clicks"]
    clicks = batch_clicks(spark, pdf[["event_id", "line"]]).join(spark.createDataFrame(pdf[["event_id", "arrival_ms"]]), "event_id")
    assert rows(ad_click_trend_by_arrival(clicks, *sizes), cols) == want
    src = write_files(pdf, 4, f"{tmpdir_}/in")
    q, t = _by_arrival(spark, src, tmpdir_, sizes, idle_ms=HOUR)
    # First and last windows included.
    _until(q, lambda: q.lastProgress and q.lastProgress["batchId"] >= 4 and rows(t.rows.current(spark), cols) == want)
    closed = {(r.adid, r.window_start_ms) for r in t.closed.current(spark).collect()}
    whole = {(ad, start) for ad, start, _, _ in want}
    newest = max(pdf["arrival_ms"])
    assert closed <= whole and all(start + sizes[0] <= newest for _, start in closed)
    assert {w for w in whole if w[1] + sizes[0] <= newest - HOUR} <= closed


def test_timers_close_windows_without_new_clicks(spark, tmpdir_):
    pdf = _arrivals(40)
    want = _brute_by_arrival(pdf, HOUR, TEN, TEN)
    whole = {(ad, start) for ad, start, _, _ in want}
    q, t = _by_arrival(spark, write_files(pdf, 1, f"{tmpdir_}/in"), tmpdir_, (HOUR, TEN, TEN), idle_ms=4_000)
    _until(q, lambda: {(r.adid, r.window_start_ms) for r in t.closed.current(spark).collect()} == whole)
    assert rows(t.rows.current(spark), ["adid", "window_start_ms", "bucket_ms", "clicks"]) == want


def test_state_options_are_checked(spark, fixture_lines, tmpdir_):  # noqa: F811
    src = write_files(fixture_lines.iloc[:3], 1, f"{tmpdir_}/in")
    with pytest.raises(ValueError):
        start_click_trend(stream_of(spark, src), f"{tmpdir_}/t", by="arrival_ms")
    with pytest.raises(ValueError):
        start_blacklist(stream_of(spark, src), f"{tmpdir_}/b", ttl_ms=5)
