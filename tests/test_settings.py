"""Session defaults give way to the cluster; filters and parsing drop nothing unasked."""

import os
import subprocess
import sys

import pytest

from clickflow.operators import filter_time_range
from clickflow.session import DEFAULTS, build_session
from clickflow.sources.adslog import MAX_MS, MIN_MS, parse_ad_lines

from .conftest import make_actions

SUBMITTED = """
from clickflow.session import build_session
s = build_session("t", master="local[1]")
print("ZONE", s.conf.get("spark.sql.session.timeZone"), s.conf.get("spark.sql.adaptive.enabled"))
s = build_session("t", conf={"spark.sql.session.timeZone": "Europe/Paris"})
print("OWN", s.conf.get("spark.sql.session.timeZone"))
"""


@pytest.mark.parametrize("submitted", [True, False])
def test_submitted_settings_survive(submitted):
    args = "--conf spark.sql.session.timeZone=Asia/Shanghai --conf spark.sql.adaptive.enabled=false" if submitted else ""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"{args} --conf spark.ui.enabled=false pyspark-shell"}
    env["PYTHONPATH"] = os.pathsep.join(p for p in sys.path if p)
    out = subprocess.run([sys.executable, "-c", SUBMITTED], env=env, capture_output=True, text=True, timeout=300).stdout
    assert ("ZONE Asia/Shanghai false" if submitted else "ZONE UTC true") in out
    assert "OWN Europe/Paris" in out


def test_active_session_settings_survive(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert build_session("again").conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert DEFAULTS["spark.sql.session.timeZone"] == "UTC"


def test_time_range_looks_at_the_time_only(spark):
    rows = [{"action_time": f"2024-01-0{i} 10:00:00"} for i in range(1, 5)]
    rows[1]["date"], rows[2]["date"] = "02.01.2024", "2020-01-01"
    df = make_actions(spark, rows)
    df = df.selectExpr("*", "if(event_id = 1, null, date) AS d").drop("date").withColumnRenamed("d", "date")
    got = sorted(r.action_time[:10] for r in filter_time_range(df, "2024-01-01", "2024-01-03 23:00:00").collect())
    assert got == ["2024-01-01", "2024-01-02", "2024-01-03"]


@pytest.mark.parametrize("ms", [9223372036854775807, -9223372036854775808, MAX_MS + 1, MIN_MS - 1])
def test_extreme_times_are_malformed(spark, ms):
    df = spark.createDataFrame([(f"{ms} p c 1 2",), ("1000 p c 1 2",), (f"{MAX_MS} p c 1 2",)], "line STRING")
    assert parse_ad_lines(df, mode="drop").count() == 2
    assert [r.ts_ms for r in parse_ad_lines(df, mode="drop").collect()] == [1000, MAX_MS]
    with pytest.raises(Exception, match="malformed ad line"):
        parse_ad_lines(df, mode="fail").collect()


def test_jdbc_rows_have_the_original_columns(spark, monkeypatch, tmpdir_):
    from clickflow import __main__ as cli

    sent = {}
    monkeypatch.setattr(cli, "write_jdbc", lambda df, url, table, *a, **k: sent.update({table: df.columns}))
    make_actions(spark, [{"click_category_id": 3}]).write.parquet(f"{tmpdir_}/uva")
    for job, extra in (("category-top", []), ("session-top", []), ("page-jump-rate", ["--target-pages", "1,2"])):
        cli.main([job, "--path", f"{tmpdir_}/uva", "--jdbc-url", "jdbc:x", *extra], spark)
    assert {t: len(c) for t, c in sent.items()} == {
        "category_top10": 5, "category_top10_session_count": 4, "pagejumprate": 3,
    }
    cli.main(["session-top", "--path", f"{tmpdir_}/uva", "--jdbc-url", "jdbc:x", "--extra-columns"], spark)
    assert "rank" in sent["category_top10_session_count"]
