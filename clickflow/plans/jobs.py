"""The offline jobs as runs: read the click log, compute, tag with a task id, append.

These are what a scheduler calls. Arguments replace the original property files:
``start``/``end`` (``startDate``/``endDate``), ``target_pages`` (``targetPageFlow``),
``top_n``. A fresh task id is drawn per run unless given.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clickflow.operators import category_session_top_n, category_top_n, filter_time_range, page_jump_rate
from clickflow.sinks.tables import DAY_COL, with_task_id
from clickflow.sources.tables import read_actions

Sink = Callable[[DataFrame], None]


def _actions(
    spark: SparkSession, table: str, path: str | None, start: str | None, end: str | None, database: str | None
) -> DataFrame:
    actions = read_actions(spark, table=table, path=path, database=database)
    return filter_time_range(actions, start, end, day_col=DAY_COL)


def _finish(df: DataFrame, task_id: str | None, sink: Sink | None) -> DataFrame:
    out = with_task_id(df, task_id or str(uuid.uuid4()))
    if sink is not None:
        sink(out)
    return out


def run_category_top(
    spark: SparkSession,
    table: str = "user_visit_action",
    path: str | None = None,
    start: str | None = None,
    end: str | None = None,
    top_n: int = 10,
    task_id: str | None = None,
    sink: Sink | None = None,
    database: str | None = None,
) -> DataFrame:
    """J1 -> (task_id, category_id, click_count, order_count, pay_count)."""
    return _finish(category_top_n(_actions(spark, table, path, start, end, database), top_n), task_id, sink)


def run_category_session_top(
    spark: SparkSession,
    table: str = "user_visit_action",
    path: str | None = None,
    start: str | None = None,
    end: str | None = None,
    top_n: int = 10,
    sessions_per_category: int = 10,
    task_id: str | None = None,
    sink: Sink | None = None,
    database: str | None = None,
) -> DataFrame:
    """J2 -> (task_id, category_id, session_id, click_count, rank)."""
    actions = _actions(spark, table, path, start, end, database)
    return _finish(category_session_top_n(actions, top_n, sessions_per_category), task_id, sink)


def run_page_jump_rate(
    spark: SparkSession,
    target_pages: str | Sequence[int],
    table: str = "user_visit_action",
    path: str | None = None,
    start: str | None = None,
    end: str | None = None,
    include_zero: bool = False,
    task_id: str | None = None,
    sink: Sink | None = None,
    database: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """J3 -> (task_id, page_jump, jump_count, view_count, jump_rate)."""
    actions = _actions(spark, table, path, start, end, database)
    rates = page_jump_rate(actions, target_pages, include_zero=include_zero, parts=parts)
    return _finish(rates, task_id, sink)
