"""K3 publish + partition pruning, job runners with task ids."""

from pyspark.sql import functions as F

from clickflow.plans.inspect import plan_text
from clickflow.plans.jobs import run_category_top
from clickflow.sinks.tables import publish_table
from clickflow.sources.fixtures import fixture_actions
from clickflow.sources.tables import read_actions

import __spark_entry__ as E


def test_publish_partitioned_table_and_prune(spark):
    E._utc(spark)
    actions = fixture_actions(spark, "/root/testdata/sf0.001")
    publish_table(actions, "uva_test", day_of="action_time")
    publish_table(actions, "uva_test", day_of="action_time")  # replace, not append
    t = read_actions(spark, table="uva_test")
    assert t.count() == actions.count()
    run = run_category_top(spark, table="uva_test", start="2024-01-05", end="2024-01-10 12:00:00", task_id="t1")
    text = plan_text(run)
    assert "PartitionFilters: [isnotnull(action_day" in text and "2024-01-05" in text
    scan = text[text.index("(1) Scan parquet"):].split("\n\n")[0]
    assert "PushedFilters: [IsNotNull(action_time), GreaterThanOrEqual(action_time,2024-01-05)" in scan
    rows = run.collect()
    assert {r.task_id for r in rows} == {"t1"}
    assert run.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]


def test_sink_callback_receives_tagged_rows(spark):
    E._utc(spark)
    got = []
    actions = fixture_actions(spark, "/root/testdata/sf0.001")
    publish_table(actions, "uva_test2")
    run_category_top(spark, table="uva_test2", top_n=3, sink=lambda df: got.append(df.count()))
    assert got == [3]
    assert spark.table("uva_test2").filter(F.col("event_id") >= 0).count() == 1000


def test_condition_json_to_job_args():
    from clickflow.plans.params import job_params
    got = job_params('{"startDate": "2024-01-05", "endDate": null, "targetPageFlow": "1,2,3", "x": 1}')
    assert got == {"start": "2024-01-05", "target_pages": "1,2,3"}
    assert job_params("") == {}


def test_actions_from_rows(spark):
    from clickflow.sources.tables import actions_from_rows
    row = ("2024-01-01", 1, "s", 2, "2024-01-01 00:00:00", None, 5, 9, None, None, None, None, 3)
    df = actions_from_rows(spark, [(7,) + row], keep_schema="event_id BIGINT")
    assert df.count() == 1 and df.columns[0] == "event_id"


def test_read_actions_from_a_database(spark):
    E._utc(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS mall")
    actions = fixture_actions(spark, "/root/testdata/sf0.001")
    publish_table(actions, "mall.user_visit_action", day_of="action_time")
    t = read_actions(spark, database="mall")
    assert t.columns[0] == "event_id" and t.count() == actions.count()
