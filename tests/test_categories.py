"""J1/J2 edge rows (FIXTURES.md section 3)."""

from clickflow.operators import category_action_counts, category_session_top_n, category_top_n, filter_time_range

from .conftest import make_actions


def counts(df):
    return {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in category_action_counts(df).collect()}


def test_classification_is_exclusive(spark):
    df = make_actions(spark, [
        {"click_category_id": 5, "order_category_ids": "1,2"},
        {"order_category_ids": "1,2", "pay_category_ids": "3"},
    ])
    assert counts(df) == {"5": (1, 0, 0), "1": (0, 1, 0), "2": (0, 1, 0)}


def test_duplicates_count_twice_and_blank_ids_drop(spark):
    df = make_actions(spark, [
        {"order_category_ids": "4,4"},
        {"order_category_ids": "1,2,,"},
        {"order_category_ids": ""},
        {"order_category_ids": ","},
        {"pay_category_ids": ",6"},
        {"order_category_ids": "a_b"},
    ])
    assert counts(df) == {
        "4": (0, 2, 0), "1": (0, 1, 0), "2": (0, 1, 0), "6": (0, 0, 1), "a_b": (0, 1, 0),
    }


def test_null_click_id_is_not_a_click(spark):
    df = make_actions(spark, [{"click_category_id": None, "pay_category_ids": "7"}])
    assert counts(df) == {"7": (0, 0, 1)}


def test_order_only_category_is_kept(spark):
    df = make_actions(spark, [{"click_category_id": 3}, {"order_category_ids": "9"}])
    top = {r.category_id: r.click_count for r in category_top_n(df, 10).collect()}
    assert top == {"3": 1, "9": 0}


def test_ties_break_by_category_id_as_string(spark):
    df = make_actions(spark, [{"click_category_id": c} for c in range(1, 12)])
    got = [r.category_id for r in category_top_n(df, 10).collect()]
    assert got == sorted(str(c) for c in range(1, 12))[:10]
    assert got[:3] == ["1", "10", "11"]


def test_top_order_click_then_order_then_pay(spark):
    rows = [{"click_category_id": 1}] * 2 + [{"click_category_id": 2}] * 2 + [{"order_category_ids": "2"}]
    rows += [{"click_category_id": 3}] * 3 + [{"pay_category_ids": "1"}]
    df = make_actions(spark, rows)
    assert [r.category_id for r in category_top_n(df, 10).collect()] == ["3", "2", "1"]


def test_session_ids_with_hyphens_stay_whole(spark):
    df = make_actions(spark, [
        {"click_category_id": 1, "session_id": "ab-1"},
        {"click_category_id": 1, "session_id": "ab-2"},
        {"click_category_id": 1, "session_id": "ab-2"},
    ])
    got = [(r.session_id, r.click_count, r.rank) for r in category_session_top_n(df).orderBy("rank").collect()]
    assert got == [("ab-2", 2, 1), ("ab-1", 1, 2)]


def test_minus_one_in_top_list_counts_no_non_clicks(spark):
    df = make_actions(spark, [{"order_category_ids": "-1"}] * 3 + [{"click_category_id": 2, "session_id": "x"}])
    top = {r.category_id for r in category_top_n(df, 10).collect()}
    assert "-1" in top
    got = [(r.category_id, r.session_id) for r in category_session_top_n(df).collect()]
    assert got == [("2", "x")]


def test_sessions_per_category_limit_and_ties(spark):
    rows = []
    for s in range(15):
        rows += [{"click_category_id": 1, "session_id": f"s{s:02d}"}] * (1 + s % 3)
    df = make_actions(spark, rows)
    got = category_session_top_n(df, 10, 10).orderBy("rank").collect()
    assert len(got) == 10
    assert [r.click_count for r in got] == [3] * 5 + [2] * 5
    assert [r.session_id for r in got[:5]] == ["s02", "s05", "s08", "s11", "s14"]


def test_time_range_is_inclusive_string_compare(spark):
    df = make_actions(spark, [
        {"action_time": "2024-01-04 23:59:59"},
        {"action_time": "2024-01-05 00:00:00"},
        {"action_time": "2024-01-06 12:00:00"},
    ])
    assert filter_time_range(df, None, "2024-01-05").count() == 1
    assert filter_time_range(df, "2024-01-05", None).count() == 2
    assert filter_time_range(df, "2024-01-05", "2024-01-05 00:00:00").count() == 1
    assert filter_time_range(df, None, None).count() == 3
    assert filter_time_range(df, "", "").count() == 3


def test_caller_supplied_category_list_is_used_whole(spark):
    rows = [{"click_category_id": c, "session_id": f"s{c}"} for c in range(1, 15)]
    df = make_actions(spark, rows)
    cats = spark.createDataFrame([(str(c),) for c in range(1, 15)], "category_id STRING")
    got = category_session_top_n(df, top_n=3, top_categories=cats)
    assert got.select("category_id").distinct().count() == 14
