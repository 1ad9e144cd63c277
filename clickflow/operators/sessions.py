"""For each top category, its top-N sessions by clicks.

Plan shape: one pruned scan -> the ids of each action -> one ``GROUPING SETS`` aggregate
(partial + final) that gives both the counts of each category and those of each of its
sessions -> ``row_number`` per category, whose filter becomes a ``WindowGroupLimit`` that also
runs before the shuffle, so a hot category ships at most N sessions per partition -> one row
per category with its counts and at most N sessions -> the top categories, unfolded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.operators.categories import category_actions, kind_counts, ranking
from clickflow.operators.filters import CLICK


def category_session_top_n(
    actions: DataFrame,
    top_n: int = 10,
    sessions_per_category: int = 10,
    top_categories: DataFrame | None = None,
) -> DataFrame:
    """(category_id, session_id, click_count, rank). Session ids are kept whole.

    Only click rows count (click id set and not -1). Ties in click count go to the
    smaller session id. ``top_categories`` may be passed in to reuse a J1 result.
    """
    if top_categories is not None:
        return _ranked_sessions(actions, top_categories.select("category_id"), sessions_per_category)
    # Orders and payments count for the category only, so they share its null session.
    session = F.when(F.col("kind") == F.lit(CLICK), F.col("session_id")).alias("session_id")
    occ = category_actions(actions, F.col("session_id")).select("kind", "category_id", session)
    counts = occ.groupingSets(
        [["category_id"], ["category_id", "session_id"]], "category_id", "session_id"
    ).agg(F.grouping("session_id").alias("_whole"), *kind_counts())
    w = Window.partitionBy("category_id", "_whole").orderBy(*_by_clicks())
    held = counts.filter("_whole = 1 or click_count > 0").withColumn("rank", F.row_number().over(w))
    whole = F.col("_whole") == 1
    sessions = F.when(~whole, F.struct("session_id", "click_count", F.col("rank").cast("bigint").alias("rank")))
    totals = [F.max(F.when(whole, F.col(c))).alias(c) for c in ("click_count", "order_count", "pay_count")]
    categories = (
        held.filter(F.col("rank") <= sessions_per_category)
        .groupBy("category_id")
        .agg(*totals, F.collect_list(sessions).alias("_sessions"))
    )
    top = categories.orderBy(*ranking()).limit(top_n)
    return top.select("category_id", F.inline("_sessions"))


def _by_clicks() -> list[F.Column]:
    return [F.col("click_count").desc(), F.col("session_id").asc()]


def _ranked_sessions(actions: DataFrame, top: DataFrame, sessions_per_category: int) -> DataFrame:
    """The sessions of given categories. Their list has no proven bound: AQE broadcasts it if
    it measures small."""
    clicks = actions.filter(
        F.col("click_category_id").isNotNull() & (F.col("click_category_id") != F.lit(-1))
    ).select(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
    counts = (
        clicks.join(top, "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("category_id").orderBy(*_by_clicks())))
    return ranked.filter(F.col("rank") <= sessions_per_category).select(
        "category_id", "session_id", "click_count", F.col("rank").cast("bigint").alias("rank")
    )
