"""time-range filter and the click / order / pay classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLICK, ORDER, PAY = "click", "order", "pay"


def _bound(value: str | None) -> str | None:
    # Null and empty both mean "no bound". (Originally an empty end bound matched
    # nothing; that is treated as a bug.)
    return value if value else None


def filter_time_range(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    time_col: str = "action_time",
    day_col: str | None = None,
) -> DataFrame:
    """Keep ``start <= action_time <= end``, compared as strings (inclusive).

    An end bound ``2024-01-05`` therefore excludes ``2024-01-05 00:00:00``. The predicate
    reaches the parquet scan. ``day_col`` names a column that is the first ten characters
    of ``time_col`` by construction (``publish_table(..., day_of="action_time")`` makes
    one); the bounds then prune its partitions too, which string order makes implied. The
    log's own ``date`` column is no such promise and is never used.
    """
    start, end = _bound(start), _bound(end)
    cond: Column | None = None

    def _and(c: Column) -> None:
        nonlocal cond
        cond = c if cond is None else cond & c

    use_day = day_col is not None and day_col in df.columns
    if start is not None:
        _and(F.col(time_col) >= F.lit(start))
        if use_day:
            _and(F.col(day_col) >= F.lit(start[:10]))
    if end is not None:
        _and(F.col(time_col) <= F.lit(end))
        if use_day:
            _and(F.col(day_col) <= F.lit(end[:10]))
    return df if cond is None else df.filter(cond)


def action_kind(
    click_col: str = "click_category_id",
    order_col: str = "order_category_ids",
    pay_col: str = "pay_category_ids",
) -> Column:
    """Exclusive kind of a row: click if the click id is set (not -1, not null), else
    order if the order list is non-null, else pay if the pay list is non-null, else null."""
    is_click = F.col(click_col).isNotNull() & (F.col(click_col) != F.lit(-1))
    return (
        F.when(is_click, F.lit(CLICK))
        .when(F.col(order_col).isNotNull(), F.lit(ORDER))
        .when(F.col(pay_col).isNotNull(), F.lit(PAY))
    )
