"""Results that are there once after failures, malformed lines kept, state read as a table."""

import json
import os
import re
import uuid

import pytest

from clickflow.operators import ads_daily_clicks
from clickflow.sinks.tables import stage_partition, write_once
from clickflow.sources.streams import ad_clicks_stream, read_ad_lines_stream
from clickflow.streaming import start_daily_clicks
from clickflow.streaming.ads_streams import start_blacklist, stored_daily_clicks
from tests.test_streaming import NOW, batch_clicks, fixture_lines, rows, stream_of, write_files  # noqa: F401


class FakeLink:
    """A DB-API connection to tables kept as a log of committed statements in a folder. Fails
    once, after some rows, if the folder holds a file ``fail``."""

    def __init__(self, folder):
        self.folder, self.pending = folder, []

    cursor = lambda self: self

    def execute(self, sql, parameters=()):
        self.pending.append((sql, [list(parameters)]))

    def executemany(self, sql, batch):
        self.pending.append((sql, [list(p) for p in batch]))
        if os.path.exists(f"{self.folder}/fail"):
            os.rename(f"{self.folder}/fail", f"{self.folder}/failed")
            raise OSError("connection lost")

    def commit(self):
        name = f"{len(os.listdir(self.folder)):06d}-{uuid.uuid4().hex}"
        with open(f"{self.folder}/{name}.tmp", "w") as f:
            json.dump(self.pending, f)
        os.rename(f"{self.folder}/{name}.tmp", f"{self.folder}/{name}.json")
        self.pending = []

    def rollback(self):
        self.pending = []

    def close(self):
        self.pending = []


def tables(folder):
    """What the committed statements leave."""
    held = {}
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".json")):
        for sql, batch in json.load(open(f"{folder}/{name}")):
            verb, table = re.match(r"(DELETE FROM|INSERT INTO) (\w+)", sql).groups()
            rows_ = held.setdefault(table, [])
            for p in batch:
                if verb == "DELETE FROM":
                    keys = re.findall(r"(\w+) = \?", sql)
                    held[table] = rows_ = [r for r in rows_ if any(r[k] != v for k, v in zip(keys, p))]
                elif "SELECT" in sql:
                    names = re.search(r"\((.*?)\)", sql)[1].split(", ")
                    source = held.get(re.search(r"FROM (\w+)", sql)[1], [])
                    rows_ += [{n: r[n] for n in names} for r in source if r["task_id"] == p[0]]
                else:
                    rows_.append(dict(zip(re.search(r"\((.*?)\)", sql)[1].split(", "), p)))
    return held


def test_rows_are_there_once_after_a_failure(spark, tmpdir_):
    folder = f"{tmpdir_}/db"
    os.makedirs(folder)
    connect = lambda: FakeLink(folder)
    df = spark.range(95).selectExpr("concat('c', id) AS category_id", "id AS clicks").repartition(3)
    want = sorted((f"c{i}", i) for i in range(95))
    open(f"{folder}/fail", "w").close()
    with pytest.raises(Exception):
        write_once(df, connect, "top", "run-1", batch_size=10)
    assert not tables(folder).get("top")
    for _ in range(2):  # the rerun, and one more
        write_once(df, connect, "top", "run-1", batch_size=10)
        held = tables(folder)
        assert sorted((r["category_id"], r["clicks"]) for r in held["top"]) == want and held["top_stage"] == []
    write_once(df.limit(1), connect, "top", "run-2")
    assert len(tables(folder)["top"]) == 96


def test_a_repeated_attempt_replaces_its_partition(tmpdir_):
    folder = f"{tmpdir_}/db"
    os.makedirs(folder)
    connect = lambda: FakeLink(folder)
    data = [("a", 1), ("b", 2), ("c", 3)]
    again = lambda part: stage_partition(data, connect, "s", "run", part, ["task_id", "k", "v"], "?", 2)
    again(0)
    open(f"{folder}/fail", "w").close()
    with pytest.raises(OSError):
        again(1)
    for part in (1, 1, 0):
        again(part)
    assert sorted((r["part"], r["k"]) for r in tables(folder)["s"]) == [(p, k) for p in (0, 1) for k in "abc"]


def test_malformed_lines_are_kept_by_batch(spark, fixture_lines, tmpdir_):  # noqa: F811
    import pandas as pd

    junk = ["", "1 a b", "x Asia c u 1", "1700000000000  c u 1", None]
    bad = pd.DataFrame({"event_id": range(10**6, 10**6 + len(junk)), "line": junk})
    mixed = pd.concat([fixture_lines.iloc[:300], bad, fixture_lines.iloc[300:500]], ignore_index=True)
    src = write_files(mixed, 3, f"{tmpdir_}/in")
    lines = read_ad_lines_stream(spark, "parquet", src, schema="event_id BIGINT, line STRING", max_per_trigger=1)
    clicks = ad_clicks_stream(lines, mode="quarantine", metrics="ad_lines")
    q, table = start_daily_clicks(clicks, f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp", quarantine=f"{tmpdir_}/bad")
    q.awaitTermination()
    assert rows(table.current(spark)) == rows(ads_daily_clicks(batch_clicks(spark, fixture_lines.iloc[:500])))
    kept = spark.read.parquet(f"{tmpdir_}/bad")
    assert {(r.event_id, r.malformed) for r in kept.collect()} == {(10**6 + i, t or "") for i, t in enumerate(junk)}
    seen = [p["observedMetrics"]["ad_lines"] for p in q.recentProgress if "ad_lines" in p.get("observedMetrics", {})]
    assert sum(m["malformed"] for m in seen) == kept.count() and sum(m["lines"] for m in seen) == len(mixed)
    with pytest.raises(ValueError):
        start_blacklist(clicks, f"{tmpdir_}/bl", state="store", quarantine=f"{tmpdir_}/no")
    with pytest.raises(ValueError):
        start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/o2", quarantine=f"{tmpdir_}/no")


def test_running_totals_are_read_from_the_state_store(spark, fixture_lines, tmpdir_):  # noqa: F811
    src = write_files(fixture_lines, 3, f"{tmpdir_}/in")
    q, table = start_daily_clicks(stream_of(spark, src), f"{tmpdir_}/out", trigger=NOW, checkpoint=f"{tmpdir_}/cp", state="store")
    q.awaitTermination()
    cols = ["day", "province", "city", "adid", "clicks"]
    assert rows(stored_daily_clicks(spark, f"{tmpdir_}/cp"), cols) == rows(table.current(spark), cols)
