"""Page-to-page jump rate along a target page flow.

Adjacent pairs come from ``lead`` in time order inside a session: one shuffle, one sort and
one window over the click log. A session may hold a third of the log (a bot, a crawler). A
session larger than a partition's share is cut into runs of its time order
(``ordered.hot_cuts``); runs are windowed like sessions of their own, and the successor of a
run's last action is the first page of the session's next run, found from one summary row per
run. There are fewer runs than twice the partitions, and results are the same wherever the
cuts lie. No group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.operators.ordered import RUN, hot_cuts, with_runs


def parse_flow(target_pages: str | Sequence[int]) -> list[int]:
    """``"1,2,3"`` or ``[1, 2, 3]`` -> ``[1, 2, 3]``."""
    if isinstance(target_pages, str):
        return [int(p) for p in target_pages.split(",") if p.strip()]
    return [int(p) for p in target_pages]


def flow_pairs(target_pages: str | Sequence[int]) -> list[tuple[int, int]]:
    """Adjacent pairs of the flow; a pair repeated in the flow is kept once."""
    pages = parse_flow(target_pages)
    seen: dict[tuple[int, int], None] = {}
    for a, b in zip(pages, pages[1:]):
        seen.setdefault((a, b), None)
    return list(seen)


def _order_cols(df: DataFrame, tiebreak: Sequence[str] | None) -> list[str]:
    # Times have second resolution, so ties are common; a tie-break column makes the
    # order (and hence the pairs) deterministic. Default: event_id if present, else
    # page_id (then equal rows give equal pairs whichever comes first).
    if tiebreak is None:
        tiebreak = ["event_id"] if "event_id" in df.columns else ["page_id"]
    return ["action_time", *[c for c in tiebreak if c != "action_time"]]


def _adjacent(actions: DataFrame, tiebreak: Sequence[str] | None, parts: int | None) -> DataFrame:
    """(session_id, action_time, page_id, next_page_id) of consecutive actions whose pages
    are both known."""
    order = _order_cols(actions, tiebreak)
    base = actions.select("session_id", *order, *([] if "page_id" in order else ["page_id"]))
    cuts = hot_cuts(base, "session_id", order, parts)
    if cuts is None:
        w = Window.partitionBy("session_id").orderBy(*order)
        pairs = base.withColumn("next_page_id", F.lead("page_id").over(w))
    else:
        pairs = _across_runs(with_runs(base, cuts, "session_id", order), order)
    return pairs.filter("page_id IS NOT NULL AND next_page_id IS NOT NULL").select(
        "session_id", "action_time", "page_id", "next_page_id"
    )


def _across_runs(base: DataFrame, order: list[str]) -> DataFrame:
    """``base`` with ``next_page_id``, where some sessions are cut into runs."""
    w = Window.partitionBy("session_id", RUN).orderBy(*order)
    # The end of a run is told by position: a page, and so its successor, may be null.
    paired = base.withColumn("_follows", F.lead(F.lit(True)).over(w)).withColumn(
        "next_page_id", F.lead("page_id").over(w)
    )
    heads = (
        base.filter(f"{RUN} IS NOT NULL")
        .groupBy("session_id", RUN)
        .agg(F.min_by(F.struct("page_id"), F.struct(*order)).alias("_head"))
    )
    runs = Window.partitionBy("session_id").orderBy(RUN)
    succ = heads.select(
        F.col("session_id").alias("_sid"), F.col(RUN).alias("_of"), F.lead("_head").over(runs).alias("_succ")
    ).filter("_succ IS NOT NULL")
    edge = F.col("session_id").eqNullSafe(F.col("_sid")) & (F.col(RUN) == F.col("_of"))
    # At most one row for each cut and hot session: fewer than twice the partitions.
    return paired.join(F.broadcast(succ), edge, "left").withColumn(
        "next_page_id", F.when(F.col("_follows"), F.col("next_page_id")).otherwise(F.col("_succ.page_id"))
    )


def session_page_pairs(
    actions: DataFrame,
    tiebreak: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """(session_id, action_time, page_id, next_page_id, page_jump) for every pair of
    consecutive actions of a session. Self pairs (``3-3``) are kept; a one-row session
    gives none. ``action_time`` is the time of the first page of the pair. An action
    without a page stands between its neighbours but gives no pair with either. ``parts``:
    partitions whose share of the log a task takes (default: the shuffle partitions)."""
    pairs = _adjacent(actions, tiebreak, parts)
    return pairs.withColumn("page_jump", F.concat_ws("-", "page_id", "next_page_id"))


def page_jump_counts(
    actions: DataFrame,
    target_pages: str | Sequence[int],
    tiebreak: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """(page_id, next_page_id, page_jump, jump_count) for the flow's pairs that occur."""
    wanted = F.lit(False)
    for a, b in flow_pairs(target_pages):
        wanted = wanted | ((F.col("page_id") == a) & (F.col("next_page_id") == b))
    return (
        _adjacent(actions, tiebreak, parts)
        .filter(wanted)
        .groupBy("page_id", "next_page_id")
        .agg(F.count(F.lit(1)).alias("jump_count"))
        .select("page_id", "next_page_id", F.concat_ws("-", "page_id", "next_page_id").alias("page_jump"), "jump_count")
    )


def page_view_counts(actions: DataFrame, target_pages: str | Sequence[int]) -> DataFrame:
    """(page_id, view_count): all actions on each page of the flow, last page included."""
    pages = sorted(set(parse_flow(target_pages)))
    return (
        actions.filter(F.col("page_id").isin(pages))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("view_count"))
    )


def page_jump_rate(
    actions: DataFrame,
    target_pages: str | Sequence[int],
    tiebreak: Sequence[str] | None = None,
    include_zero: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """(page_jump, jump_count, view_count, jump_rate) with
    ``jump_rate = jumps(a-b) / views(a) * 100`` (views of ``a`` count all its actions,
    not sessions). Pairs with no jump are left out unless ``include_zero``."""
    jumps = page_jump_counts(actions, target_pages, tiebreak, parts)
    # At most len(target_pages) rows: broadcast is bounded by the parameter.
    views = F.broadcast(page_view_counts(actions, target_pages))
    if include_zero:
        spark = actions.sparkSession
        flow = spark.createDataFrame(
            [(a, b, f"{a}-{b}") for a, b in flow_pairs(target_pages)],
            "page_id BIGINT, next_page_id BIGINT, page_jump STRING",
        )
        # Both sides hold at most the flow's pairs; the right one is the side that is built.
        jumps = flow.join(
            F.broadcast(jumps.select("page_jump", "jump_count")), "page_jump", "left"
        ).select("page_id", "page_jump", F.coalesce("jump_count", F.lit(0).cast("bigint")).alias("jump_count"))
        joined = jumps.join(views, "page_id", "left")
        view_count = F.coalesce(F.col("view_count"), F.lit(0).cast("bigint"))
    else:
        joined = jumps.join(views, "page_id")
        view_count = F.col("view_count")
    rate = F.when(
        view_count > 0,
        F.col("jump_count").cast("double") / view_count.cast("double") * F.lit(100.0),
    )
    return joined.select(
        "page_jump", "jump_count", view_count.alias("view_count"), rate.alias("jump_rate")
    )
