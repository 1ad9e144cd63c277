"""Plan shapes that matter at scale."""

import __spark_entry__ as E
from clickflow.plans.inspect import count_nodes, plan_text

SF = "/root/testdata/sf0.001"


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_category_counts_scan_once(spark):
    df = q(spark, "category_action_counts")
    assert count_nodes(df, "Scan parquet") == 1
    assert count_nodes(df, "Exchange") == 1  # partial+final aggregate, one shuffle
    text = plan_text(df)
    assert "ReadSchema: struct<event_id" not in text or "value:" not in text  # pruned
    assert "partial_count" in text


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_text(q(spark, "category_top10"))


def test_session_top_scans_once_and_limits_groups(spark):
    df = q(spark, "category_session_top10")
    text = plan_text(df)
    assert text.count("WindowGroupLimit") >= 2  # map side and reduce side
    assert count_nodes(df, "Scan parquet") == 1 and "Join" not in text
    assert count_nodes(df, "Expand") == 1 and "TakeOrderedAndProject" in text


def test_ban_search_ships_counts_not_clicks(spark):
    from clickflow.operators import first_bans

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for threshold in (20, 5000):
            df = first_bans(E._clicks(spark, SF), threshold)
            df.collect()  # final adaptive plan: no group is above the threshold
            tree = plan_text(df).split("\n\n")[0].split("== Initial Plan ==")[0]
            # The minutes' counts are shuffled and summed in order; no minute crosses, so the
            # join with the clicks is empty.
            assert "SortMergeJoin" not in tree and "WindowGroupLimit" not in tree
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_minutes_are_counted_before_the_first_shuffle_of_clicks(spark):
    from clickflow.operators import first_bans

    tree = plan_text(first_bans(E._clicks(spark, SF), 2)).split("\n\n")[0].split("\n")
    window = max(i for i, line in enumerate(tree) if " Window" in line)  # the sum over minutes
    below = [line.split("- ")[-1].split(" (")[0] for line in tree[window:]]
    assert below[1:6] == ["Sort", "Exchange", "HashAggregate", "Exchange", "HashAggregate"]


def test_session_adjacency_sorts_once(spark):
    df = q(spark, "session_page_pairs")
    df.collect()  # final adaptive plan
    tree = plan_text(df).split("\n\n")[0].split("== Initial Plan ==")[0]
    assert tree.count("Window") == 1 and "Union" not in tree


def test_categories_explode_inside_codegen(spark):
    df = q(spark, "category_action_counts")
    df.collect()
    tree = plan_text(df).split("\n\n")[0].split("== Initial Plan ==")[0]
    assert any("Generate" in line and "* Generate" in line for line in tree.split("\n"))


def test_trend_fans_out_after_aggregation(spark):
    text = plan_text(q(spark, "ads_click_trend"))
    tree = text.split("\n\n")[0]
    # Generate (the fan-out) sits above the final aggregate, not under the partial one.
    assert tree.index("Generate") < tree.index("HashAggregate")
