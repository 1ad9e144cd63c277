"""Category action counts and the top-N categories.

Plan shape: one pruned scan -> one ``explode`` of the row's category ids (the kind
is exclusive, so each row contributes to one kind only) -> partial ``HashAggregate``
-> shuffle on category -> final aggregate -> ``TakeOrderedAndProject``. A hot category
is collapsed map-side by the partial aggregate; no key is ever concatenated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.lists import split_ids
from clickflow.operators.filters import CLICK, ORDER, PAY, action_kind


def category_actions(actions: DataFrame, *keep: F.Column) -> DataFrame:
    """One row per (category_id STRING, kind) occurrence, with columns ``keep`` of its action;
    rows of no kind drop out."""
    kind = action_kind()
    ids = (
        F.when(kind == F.lit(CLICK), F.array(F.col("click_category_id").cast("string")))
        .when(kind == F.lit(ORDER), split_ids("order_category_ids"))
        .when(kind == F.lit(PAY), split_ids("pay_category_ids"))
    )
    return actions.select(kind.alias("kind"), F.explode(ids).alias("category_id"), *keep).filter("category_id <> ''")


def kind_counts() -> list[F.Column]:
    """Aggregates over ``category_actions``: click_count, order_count, pay_count."""
    kinds = {"click_count": CLICK, "order_count": ORDER, "pay_count": PAY}
    return [F.count_if(F.col("kind") == F.lit(kind)).cast("bigint").alias(name) for name, kind in kinds.items()]


def ranking() -> list[F.Column]:
    """Categories by clicks, then orders, then payments, descending; ties go to the smaller id."""
    return [F.col(c).desc() for c in ("click_count", "order_count", "pay_count")] + [F.col("category_id").asc()]


def category_action_counts(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), missing kinds counted as 0."""
    return category_actions(actions).groupBy("category_id").agg(*kind_counts())


def rank_categories(counts: DataFrame, top_n: int = 10) -> DataFrame:
    """Top ``top_n`` by clicks, then orders, then payments, all descending; ties go to
    the smaller ``category_id`` as a string. A global top-k: Spark keeps ``top_n`` rows
    per partition before the single merge, so the driver never sees more."""
    return counts.orderBy(*ranking()).limit(top_n)


def category_top_n(actions: DataFrame, top_n: int = 10) -> DataFrame:
    return rank_categories(category_action_counts(actions), top_n)
