"""J3 edge rows and the chunked adjacency against a brute-force reference."""

import random

from clickflow.operators import page_jump_counts, page_jump_rate, page_view_counts, session_page_pairs
from clickflow.operators.pagejump import flow_pairs

from .conftest import make_actions


def _session(pages, session="s", start_sec=0, step=1):
    out = []
    for i, p in enumerate(pages):
        t = start_sec + i * step
        out.append({"session_id": session, "page_id": p,
                    "action_time": f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}"})
    return out


def test_jump_rate_counts_all_views_of_source(spark):
    df = make_actions(spark, _session([1, 1, 2]))
    got = [(r.page_jump, r.jump_count, r.view_count, r.jump_rate) for r in page_jump_rate(df, "1,2").collect()]
    assert got == [("1-2", 1, 2, 50.0)]


def test_only_adjacent_pairs(spark):
    df = make_actions(spark, _session([1, 3, 2]))
    assert page_jump_counts(df, [1, 2]).count() == 0
    assert page_jump_rate(df, [1, 2]).count() == 0
    zero = page_jump_rate(df, [1, 2], include_zero=True).collect()
    assert [(r.page_jump, r.jump_count, r.jump_rate) for r in zero] == [("1-2", 0, 0.0)]


def test_repeated_flow_pairs_count_once():
    assert flow_pairs("1,2,1,2") == [(1, 2), (2, 1)]


def test_one_row_session_has_no_pair_but_a_view(spark):
    df = make_actions(spark, _session([1], "a") + _session([2], "b"))
    assert session_page_pairs(df).count() == 0
    assert {r.page_id: r.view_count for r in page_view_counts(df, [1, 2]).collect()} == {1: 1, 2: 1}


def test_same_second_ordered_by_tiebreak(spark):
    rows = [{"session_id": "s", "page_id": p, "action_time": "2024-01-01 00:00:00"} for p in (5, 3, 4)]
    df = make_actions(spark, rows)  # event_id 0, 1, 2
    got = sorted((r.page_id, r.next_page_id) for r in session_page_pairs(df).collect())
    assert got == [(3, 4), (5, 3)]


def test_last_flow_page_is_counted_as_view(spark):
    df = make_actions(spark, _session([1, 2, 3]))
    assert {r.page_id: r.view_count for r in page_view_counts(df, "1,2,3").collect()} == {1: 1, 2: 1, 3: 1}


def _brute_pairs(rows):
    by_session = {}
    for i, r in enumerate(rows):
        by_session.setdefault(r["session_id"], []).append((r["action_time"], i, r["page_id"]))
    out = []
    for s, acts in by_session.items():
        acts.sort()
        for (t, _, a), (_, _, b) in zip(acts, acts[1:]):
            out.append((s, t, a, b))
    return sorted(out, key=repr)


def _some_actions(rnd, sessions, most):
    rows = []
    for s in range(sessions):
        for _ in range(rnd.randint(1, most)):
            # Times spread over days and hours, with many same-second ties.
            t = f"2024-01-{rnd.randint(1, 3):02d} {rnd.choice([0, 1, 5, 23]):02d}:{rnd.randint(0, 2):02d}:00"
            rows.append({"session_id": f"u-{s}" if s else None, "page_id": rnd.randint(1, 4), "action_time": t})
    return rows


def _pairs(df, **options):
    return sorted(
        ((r.session_id, r.action_time, r.page_id, r.next_page_id) for r in session_page_pairs(df, **options).collect()), key=repr
    )


def test_cut_adjacency_equals_brute_force(spark, monkeypatch):
    from clickflow.operators import ordered

    rows = _some_actions(random.Random(7), 6, 60)
    df = make_actions(spark, rows)
    expect = sorted(_brute_pairs(rows), key=repr)
    assert _pairs(df) == expect  # a table this small has no hot session
    monkeypatch.setattr(ordered, "SAMPLE_PER_PART", 2)
    for parts in (2, 5, 20, 60):  # none, some, all sessions in runs of a few rows
        assert _pairs(df, parts=parts) == expect, parts
    assert ordered.hot_cuts(df, "session_id", ["action_time", "event_id"], 20) is not None


def test_hot_session_spreads_without_static_broadcasts(spark):
    from pyspark.sql import functions as F

    hot = spark.range(100_000).select(F.lit("bot").alias("session_id"), "id")
    rest = spark.range(100_000, 200_000).select((F.col("id") % 5000).cast("string").alias("session_id"), "id")
    log = hot.unionByName(rest).select(
        "session_id", F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 997), "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        (F.col("id") % 11).alias("page_id"), F.col("id").alias("event_id"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # these rows are few bytes
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        pairs = session_page_pairs(log).filter("session_id = 'bot'")
        tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        # The session holds 16 of the 32 shares.
        assert sum(tasks) == 99_999 and len(tasks) > 8 and max(tasks) < 40_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_without_event_id_ties_break_on_page(spark):
    rows = [{"session_id": "s", "page_id": p, "action_time": "2024-01-01 00:00:00"} for p in (5, 3, 4)]
    df = make_actions(spark, rows).drop("event_id")
    got = sorted((r.page_id, r.next_page_id) for r in session_page_pairs(df).collect())
    assert got == [(3, 4), (4, 5)]


def test_null_page_gives_no_pair(spark):
    df = make_actions(spark, _session([1, None, 2, 3]))
    assert [p[2:] for p in _pairs(df)] == [(2, 3)]


def test_null_page_at_the_edge_of_a_run(spark, monkeypatch):
    from clickflow.operators import ordered

    monkeypatch.setattr(ordered, "SAMPLE_PER_PART", 1)
    pages = [1, None, 2, 3, None, None, 4, 5, 6, None, 7, 8]
    df = make_actions(spark, _session(pages, step=3600))
    expect = [(a, b) for a, b in zip(pages, pages[1:]) if a and b]
    for parts in (3, 6, 11):
        assert [p[2:] for p in _pairs(df, parts=parts)] == expect, parts
