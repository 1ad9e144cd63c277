"""The command line on the test tables (batch to parquet, stream with availableNow)."""

import __spark_entry__ as E
from clickflow.__main__ import main
from clickflow.operators import blacklisted_users, category_top_n, page_jump_rate
from clickflow.sources.fixtures import fixture_actions, fixture_ad_lines

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_category_top_to_parquet(spark, tmpdir_):
    E._utc(spark)
    actions = fixture_actions(spark, SF)
    actions.write.parquet(f"{tmpdir_}/uva")
    main(["category-top", "--path", f"{tmpdir_}/uva", "--output", f"{tmpdir_}/out", "--task-id", "t9"], spark)
    out = spark.read.parquet(f"{tmpdir_}/out")
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    assert _rows(out, cols) == _rows(category_top_n(actions, 10), cols)
    assert {r.task_id for r in out.collect()} == {"t9"}


def test_page_jump_rate_with_condition_json(spark, tmpdir_):
    E._utc(spark)
    actions = fixture_actions(spark, SF)
    actions.write.parquet(f"{tmpdir_}/uva")
    cond = '{"startDate": "2024-01-03", "endDate": "2024-01-20", "targetPageFlow": "1,2,3,4"}'
    main(["page-jump-rate", "--path", f"{tmpdir_}/uva", "--conditions", cond, "--output", f"{tmpdir_}/out",
          "--parts", "3"], spark)
    from clickflow.operators import filter_time_range
    expect = page_jump_rate(filter_time_range(actions, "2024-01-03", "2024-01-20"), "1,2,3,4")
    cols = ["page_jump", "jump_count", "view_count", "jump_rate"]
    assert _rows(spark.read.parquet(f"{tmpdir_}/out"), cols) == _rows(expect, cols)


def test_blacklist_stream_available_now(spark, tmpdir_):
    E._utc(spark)
    lines = fixture_ad_lines(spark, SF)
    lines.coalesce(1).write.parquet(f"{tmpdir_}/in")
    main(["ads-blacklist", "--source", "parquet", "--input", f"{tmpdir_}/in", "--output", f"{tmpdir_}/bl",
          "--threshold", "2", "--available-now", "--checkpoint", f"{tmpdir_}/cp"], spark)
    from clickflow.sinks.keyed import KeyedTable
    bans = KeyedTable(f"{tmpdir_}/bl/bans", "userid STRING", ["userid"], "set", compact_every=50)
    from clickflow.operators.ads import with_day
    from clickflow.sources.adslog import parse_ad_lines
    clicks = with_day(parse_ad_lines(lines, keep=["event_id"]))
    assert _rows(bans.current(spark), ["userid"]) == _rows(blacklisted_users(clicks, 2), ["userid"])


def test_top_ads_and_daily_clicks_streams(spark, tmpdir_):
    from clickflow.operators import ads_daily_clicks, province_top_ads, province_top_ads_json
    from clickflow.operators.ads import with_day
    from clickflow.sinks.keyed import KeyedTable
    from clickflow.sources.adslog import parse_ad_lines
    E._utc(spark)
    lines = fixture_ad_lines(spark, SF)
    lines.coalesce(1).write.parquet(f"{tmpdir_}/in")
    clicks = with_day(parse_ad_lines(lines, keep=["event_id"]))
    main(["ads-top", "--source", "parquet", "--input", f"{tmpdir_}/in", "--output", f"{tmpdir_}/top",
          "--available-now", "--checkpoint", f"{tmpdir_}/cp1"], spark)
    top = KeyedTable(f"{tmpdir_}/top/top", "day STRING, province STRING, top_ads_json STRING",
                     ["day", "province"], "latest", compact_every=50, partition_by="day")
    cols = ["day", "province", "top_ads_json"]
    assert _rows(top.current(spark), cols) == _rows(province_top_ads_json(province_top_ads(clicks, 3)), cols)
    main(["ads-daily-clicks", "--source", "parquet", "--input", f"{tmpdir_}/in", "--output", f"{tmpdir_}/daily",
          "--available-now", "--checkpoint", f"{tmpdir_}/cp2"], spark)
    daily = KeyedTable(f"{tmpdir_}/daily/daily_clicks", "day STRING, province STRING, city STRING, adid STRING, clicks BIGINT",
                       ["day", "province", "city", "adid"], "latest", compact_every=50, partition_by="day")
    cols = ["day", "province", "city", "adid", "clicks"]
    assert _rows(daily.current(spark), cols) == _rows(ads_daily_clicks(clicks), cols)
