"""Streaming jobs J4-J7 on a parsed click stream.

Common shape: source -> parse (same code as batch) -> ``foreachBatch`` body that adds the
batch's own counts to summing ``KeyedTable``s under batch id N and rebuilds what they touch.
Bodies read only batches <= N of their own tables, so re-running batch N after a failure
rewrites the same rows: the outputs are exactly-once although the sinks are plain files.
Checkpoints default to the shared ``spark.checkpoint.dir``.

No job drops a late click: counts are kept in tables, by the click's own day, not behind a
watermark, so a table read after any batch equals the batch job over all clicks so far,
however late or skewed their clocks. (J5 offers the streaming state store instead, with a
watermark only if the caller names one.) Days are local days of the session zone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickflow.functions.timefmt import bucket_start_ms, clock_label, day_label, stamp_label
from clickflow.operators.ads import (
    REFERENCE_BUCKET_MS,
    REFERENCE_SLIDE_MS,
    REFERENCE_WINDOW_MS,
    _check_trend_sizes,
    ad_click_trend_json,
    ads_daily_clicks,
    province_ad_clicks,
    province_top_ads,
    province_top_ads_json,
    rank_province_ads,
)
from clickflow.operators.blacklist import DEFAULT_THRESHOLD, over_threshold, user_ad_daily_clicks
from clickflow.session import stream_checkpoint
from clickflow.sinks.keyed import KeyedTable
from clickflow.sources.adslog import FIELDS
from clickflow.streaming.processors import BanProcessor, TrendProcessor

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}
# Keyed state is compacted into a snapshot every this many micro-batches, so a batch
# reads one snapshot plus fewer deltas, however long the stream has run.
DEFAULT_COMPACT_EVERY = 50


def _start(
    df: DataFrame, name: str, body, mode: str, trigger: dict | None, checkpoint: str | None, quarantine: str | None = None
) -> StreamingQuery:
    if quarantine is not None:
        body = quarantining(body, quarantine_table(df, quarantine))
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
        .foreachBatch(body)
    )
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def quarantine_table(lines: DataFrame, path: str) -> KeyedTable:
    """The table of malformed lines of a stream parsed with ``mode="quarantine"``: the line and
    the columns kept from its source."""
    if "malformed" not in lines.columns:
        raise ValueError("a quarantine needs lines parsed with mode='quarantine'")
    kept = [f for f in lines.schema.fields if f.name not in ("day", "ts", *FIELDS)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    table = KeyedTable(path, schema, keys=[f.name for f in kept], kind="append")
    table.ensure(lines.sparkSession)
    return table


def quarantining(body, table: KeyedTable):
    """``body`` for the clicks of a micro-batch, after its malformed lines went to ``table`` under
    the batch's id. The batch is read and parsed once for both."""

    def both(df: DataFrame, n: int) -> None:
        df = df.persist()
        try:
            table.write(df.filter("malformed IS NOT NULL"), n)
            body(df.filter("malformed IS NULL").drop("malformed"), n)
        finally:
            df.unpersist()

    return both


def _local_days(clicks: DataFrame, watermark: str | None) -> tuple[DataFrame, F.Column, F.Column]:
    """(clicks with their local time, day window, day label) for local days of the session zone.

    Each instant is shifted by its own UTC offset (``from_utc_timestamp``), so that UTC
    day windows on the shifted time are exactly the local days, 23- and 25-hour days
    included; the window start is shifted back to render its label. A watermark is on the
    shifted column, which the window uses, so old days are evicted; without one, none are.
    """
    zone = clicks.sparkSession.conf.get("spark.sql.session.timeZone")
    shifted = clicks.withColumn("_local_ts", F.from_utc_timestamp("ts", zone))
    if watermark is not None:
        shifted = shifted.withWatermark("_local_ts", watermark)
    window = F.window("_local_ts", "1 day").alias("w")
    label = F.date_format(F.to_utc_timestamp(F.col("w.start"), zone), "yyyy-MM-dd").alias("day")
    return shifted, window, label


def _no_quarantine_with(state: str, quarantine: str | None) -> None:
    if state == "store" and quarantine is not None:
        raise ValueError("a quarantine belongs to state='deltas': the state store sees clicks before the batch body")


# --------------------------------------------------------------------------- J5
def stored_daily_clicks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(day, province, city, adid, clicks): the running totals of ``start_daily_clicks(...,
    state="store")`` as the last committed batch left them in the state store of its
    ``checkpoint``, read as a table, also while the query is down."""
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["key"].dataType.fieldNames()
    window, rest = names[0], names[1:]
    zone = spark.conf.get("spark.sql.session.timeZone")
    start = F.to_utc_timestamp(F.col(f"key.`{window}`.start"), zone)
    return state.select(
        F.date_format(start, "yyyy-MM-dd").alias("day"),
        *[F.col(f"key.`{c}`").alias(n) for c, n in zip(rest, ("province", "city", "adid"))],
        F.col(f"value.`{state.schema['value'].dataType.fieldNames()[0]}`").alias("clicks"),
    )


def start_daily_clicks(
    clicks: DataFrame,
    table_path: str,
    watermark: str | None = None,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    compact_every: int = DEFAULT_COMPACT_EVERY,
    name: str = "ads_daily_clicks",
    output_mode: str = "update",
    state: str = "deltas",
    quarantine: str | None = None,
) -> tuple[StreamingQuery, KeyedTable]:
    """Running clicks per (day, province, city, adid).

    ``state="deltas"`` (default) keeps no streaming state: each batch adds its own counts to
    a summing table (the increment variant of the original), and reading the table sums
    them. Clicks of any age are counted.

    ``state="store"`` keeps the running counts in the streaming state store. Update mode: a
    batch writes only the keys it changed, with their running totals. ``output_mode=
    "complete"`` re-writes every key every batch, as the original did; its writes grow with
    the key count. Without ``watermark`` the store keeps every day. With one, it evicts days
    older than that behind the newest click seen, and later clicks of such days are lost
    (Spark reports them as ``numRowsDroppedByWatermark``): the caller's choice.
    """
    if output_mode not in ("update", "complete"):
        raise ValueError("output_mode must be 'update' or 'complete'")
    if state not in ("store", "deltas"):
        raise ValueError("state must be 'store' or 'deltas'")
    if state == "deltas" and (watermark is not None or output_mode != "update"):
        raise ValueError("watermark and output_mode belong to state='store'")
    _no_quarantine_with(state, quarantine)
    spark = clicks.sparkSession
    if state == "deltas":
        deltas = KeyedTable(
            table_path,
            "day STRING, province STRING, city STRING, adid STRING, clicks BIGINT",
            keys=["day", "province", "city", "adid"],
            kind="sum",
            compact_every=compact_every,
            partition_by="day",
        )
        deltas.ensure(spark)
        body = lambda df, n: deltas.write(ads_daily_clicks(df), n)
        return _start(clicks, name, body, "append", trigger, checkpoint, quarantine), deltas
    table = KeyedTable(
        table_path,
        "day STRING, province STRING, city STRING, adid STRING, clicks BIGINT",
        keys=["day", "province", "city", "adid"],
        kind="latest",
        compact_every=compact_every,
        partition_by="day",
    )
    table.ensure(spark)
    timed, day_window, local_day = _local_days(clicks, watermark)
    counts = (
        timed.groupBy(day_window, "province", "city", "adid")
        .agg(F.count(F.lit(1)).alias("clicks"))
        .select(local_day, "province", "city", "adid", "clicks")
    )
    q = _start(counts, name, lambda df, n: table.write(df, n), output_mode, trigger, checkpoint)
    return q, table


# --------------------------------------------------------------------------- J6
def start_province_top_ads(
    clicks: DataFrame,
    counts_path: str,
    top_path: str,
    top_n: int = 3,
    scope: str = "day",
    trigger: dict | None = None,
    checkpoint: str | None = None,
    compact_every: int = DEFAULT_COMPACT_EVERY,
    name: str = "ads_province_top",
    quarantine: str | None = None,
) -> tuple[StreamingQuery, KeyedTable]:
    """Top ads per (day, province) as JSON, keyed by (day, province).

    ``scope="day"``: ranking over the running daily counts. Each batch adds its counts to a
    summing table and re-ranks the (day, province) groups it touched from their current
    sums. ``scope="batch"`` ranks each micro-batch alone, as the original code did.
    """
    if scope not in ("day", "batch"):
        raise ValueError("scope must be 'day' or 'batch'")
    spark = clicks.sparkSession
    top_table = KeyedTable(
        top_path,
        "day STRING, province STRING, top_ads_json STRING",
        keys=["day", "province"],
        kind="latest",
        compact_every=compact_every,
        partition_by="day",
    )
    top_table.ensure(spark)
    if scope == "batch":
        def body_batch(df: DataFrame, n: int) -> None:
            top_table.write(province_top_ads_json(province_top_ads(df, top_n)), n)

        return _start(clicks, name, body_batch, "append", trigger, checkpoint, quarantine), top_table

    counts_table = KeyedTable(
        counts_path,
        "day STRING, province STRING, adid STRING, clicks BIGINT",
        keys=["day", "province", "adid"],
        kind="sum",
        compact_every=compact_every,
        partition_by="day",
    )
    counts_table.ensure(spark)
    body = province_top_body(counts_table, top_table, top_n)
    return _start(clicks, name, body, "append", trigger, checkpoint, quarantine), top_table


def province_top_body(counts_table: KeyedTable, top_table: KeyedTable, top_n: int):
    """Per-batch body of the daily top-ads stream: add the batch's counts, then re-rank the
    touched (day, province) groups from their current counts. Days are read by the folders
    the batch wrote; the semi join only references grouping keys, so Catalyst pushes it
    below the merge aggregate."""

    def body(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        counts_table.write(province_ad_clicks(df), n)
        touched = counts_table.batch(spark, n).select("day", "province").distinct()
        days = counts_table.partitions_of(spark, n)
        current = counts_table.current(spark, upto=n, partitions=days).join(touched, ["day", "province"], "left_semi")
        top_table.write(province_top_ads_json(rank_province_ads(current, top_n)), n)

    return body


# --------------------------------------------------------------------------- J7
@dataclass
class TrendTables:
    slots: KeyedTable  # (day, adid, slot_ms, clicks) summed over batches
    rows: KeyedTable  # (day, adid, window_start_ms, bucket_ms, ..., clicks)
    windows: KeyedTable  # (day, adid, window_start_ms, ..., trend_json)
    latest: KeyedTable  # (adid, ..., trend_json): newest window per ad
    closed: KeyedTable | None = None  # (day, adid, window_start_ms): windows that get no more clicks


def start_click_trend(
    clicks: DataFrame,
    root: str,
    window_ms: int = REFERENCE_WINDOW_MS,
    slide_ms: int = REFERENCE_SLIDE_MS,
    bucket_ms: int = REFERENCE_BUCKET_MS,
    twelve_hour: bool = False,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    compact_every: int = DEFAULT_COMPACT_EVERY,
    name: str = "ads_click_trend",
    state: str = "deltas",
    by: str = "ts_ms",
    ttl_ms: int | None = None,
    idle_ms: int | None = None,
    quarantine: str | None = None,
) -> tuple[StreamingQuery, TrendTables]:
    """Clicks per ad per bucket in sliding event-time windows, live: after each batch, every
    window with a click so far stands in ``rows`` and ``windows`` as the batch job would give
    it, the newest, still open ones included; ``latest`` keeps, per ad, the newest window
    (what the original hash field held).

    Clicks are summed per (ad, slot), where a slot is the greatest length that divides
    window, slide and bucket, so a slot lies in each window and bucket as a whole. A batch
    rebuilds the windows its slots touch: with ``state="deltas"`` (default) from a table of the
    sums of the days around them, with ``state="store"`` from a ring of slots per ad in the state
    store, which costs the slots of the touched windows whatever else the days hold. ``ttl_ms``
    drops stored slots that got no click for so long; by default none are.

    ``by="arrival_ms"`` (with ``state="store"``) cuts windows by the arrival stamp of that column,
    as the original job did, and buckets by event time. Stamps of an ad only rise: a window is
    closed (in ``closed``) when a later slot arrives, or by a timer ``idle_ms`` (default: one
    window and a slide) after the ad's last click. A query with timers never runs out of
    batches: stop it, also under ``availableNow``.
    """
    if state not in ("deltas", "store") or (state == "deltas" and (by != "ts_ms" or ttl_ms is not None)):
        raise ValueError("state must be 'deltas' or 'store'; by and ttl_ms belong to state='store'")
    _no_quarantine_with(state, quarantine)
    _check_trend_sizes(window_ms, slide_ms, bucket_ms, twelve_hour)
    spark = clicks.sparkSession
    labels = "window_start STRING, window_end STRING"
    tables = TrendTables(
        slots=KeyedTable(
            f"{root}/slots", "day STRING, adid STRING, slot_ms BIGINT, clicks BIGINT",
            keys=["day", "adid", "slot_ms"], kind="sum", compact_every=compact_every, partition_by="day",
        ),
        rows=KeyedTable(
            f"{root}/rows",
            f"day STRING, adid STRING, window_start_ms BIGINT, {labels}, bucket_ms BIGINT, bucket_time STRING, clicks BIGINT"
            + (", closed BOOLEAN" if state == "store" else ""),
            keys=["day", "adid", "window_start_ms", "bucket_ms"], kind="latest", compact_every=compact_every,
            partition_by="day",
        ),
        windows=KeyedTable(
            f"{root}/windows", f"day STRING, adid STRING, window_start_ms BIGINT, {labels}, trend_json STRING",
            keys=["day", "adid", "window_start_ms"], kind="latest", compact_every=compact_every, partition_by="day",
        ),
        latest=KeyedTable(
            f"{root}/latest", f"adid STRING, window_start_ms BIGINT, {labels}, trend_json STRING",
            keys=["adid"], kind="latest", compact_every=compact_every,
        ),
    )
    if state == "store":
        tables.closed = KeyedTable(
            f"{root}/closed", "day STRING, adid STRING, window_start_ms BIGINT",
            keys=["day", "adid", "window_start_ms"], kind="set", compact_every=compact_every, partition_by="day",
        )
    for t in (tables.slots, tables.rows, tables.windows, tables.latest, tables.closed):
        if t is not None:
            t.ensure(spark)
    if state == "deltas":
        body = click_trend_body(tables, window_ms, slide_ms, bucket_ms, twelve_hour)
        return _start(clicks, name, body, "append", trigger, checkpoint, quarantine), tables
    arrival = by != "ts_ms"
    slot = math.gcd(window_ms, slide_ms) if arrival else math.gcd(window_ms, slide_ms, bucket_ms)
    if arrival and idle_ms is None:
        idle_ms = window_ms + slide_ms
    slots = clicks.select(
        "adid", bucket_start_ms(by, slot).alias("slot_ms"), bucket_start_ms("ts_ms", bucket_ms).alias("bucket_ms"),
        F.lit(1).cast("bigint").alias("clicks"),
    )
    rings = slots.groupBy("adid").transformWithState(
        statefulProcessor=TrendProcessor(window_ms, slide_ms, slot, ttl_ms, idle_ms if arrival else None),
        outputStructType="adid STRING, window_start_ms BIGINT, bucket_ms BIGINT, clicks BIGINT, closed BOOLEAN",
        outputMode="Update",
        timeMode="ProcessingTime" if arrival or ttl_ms is not None else "None",
    )
    body = ring_body(tables, window_ms, twelve_hour)
    return _start(rings, name, body, "update", trigger, checkpoint), tables


def _days_around(day: str, reach: int) -> list[str]:
    """The labels of a day and its neighbours."""
    at = date.fromisoformat(day).toordinal()
    return [date.fromordinal(d).isoformat() for d in range(max(1, at - reach), min(date.max.toordinal(), at + reach) + 1)]


def click_trend_body(tables: TrendTables, window_ms: int, slide_ms: int, bucket_ms: int, twelve_hour: bool = False):
    """The per-batch body of the trend stream."""
    slot = math.gcd(window_ms, slide_ms, bucket_ms)

    def fan_out(slots: DataFrame) -> DataFrame:
        # Starts of the windows [start, start + window) that hold the slot.
        last = F.col("slot_ms") - F.pmod(F.col("slot_ms"), F.lit(slide_ms))
        first = last - F.lit((window_ms - 1) // slide_ms * slide_ms)
        fanned = slots.withColumn("window_start_ms", F.explode(F.sequence(first, last, F.lit(slide_ms).cast("bigint"))))
        return fanned.filter(F.col("slot_ms") < F.col("window_start_ms") + F.lit(window_ms))

    def body(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        start = bucket_start_ms("ts_ms", slot)
        counted = df.groupBy(start.alias("slot_ms"), "adid").agg(F.count(F.lit(1)).alias("clicks"))
        tables.slots.write(counted.withColumn("day", day_label("slot_ms")), n)
        touched = fan_out(tables.slots.batch(spark, n)).select("adid", "window_start_ms").distinct()
        # A window is no longer than a day of 24 hours, so it reaches at most two labels away.
        days = {d for day in tables.slots.partitions_of(spark, n) for d in _days_around(day, 2)}
        known = tables.slots.current(spark, upto=n, partitions=sorted(days))
        rows = (
            fan_out(known)
            .join(touched, ["adid", "window_start_ms"], "left_semi")
            .groupBy("adid", "window_start_ms", bucket_start_ms("slot_ms", bucket_ms).alias("bucket_ms"))
            .agg(F.sum("clicks").alias("clicks"))
        )
        tables.rows.write(_labelled(rows, window_ms, twelve_hour), n)
        _write_windows(tables, spark, n)

    return body


def ring_body(tables: TrendTables, window_ms: int, twelve_hour: bool = False):
    """The per-batch body of the trend stream with rings in the state store. The processor's
    rows are read once, into the slots of the batch's folder."""

    def body(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        rows = _labelled(df, window_ms, twelve_hour, keep=["closed"])
        tables.rows.write(rows, n)
        if tables.closed is not None:
            done = tables.rows.batch(spark, n).filter("closed").select("day", "adid", "window_start_ms").distinct()
            tables.closed.write(done, n)
        _write_windows(tables, spark, n)

    return body


def _labelled(rows: DataFrame, window_ms: int, twelve_hour: bool, keep: list[str] | None = None) -> DataFrame:
    return rows.select(
        day_label("window_start_ms").alias("day"), "adid", "window_start_ms",
        stamp_label("window_start_ms").alias("window_start"),
        stamp_label(F.col("window_start_ms") + F.lit(window_ms)).alias("window_end"),
        "bucket_ms", clock_label("bucket_ms", twelve_hour).alias("bucket_time"), "clicks", *(keep or []),
    )


def _write_windows(tables: TrendTables, spark, n: int) -> None:
    """The windows of a batch's rows as JSON, and the newest window of their ads."""
    windows = ad_click_trend_json(tables.rows.batch(spark, n), keep=["day", "window_start_ms"])
    tables.windows.write(windows, n)
    value = F.struct("window_start_ms", "window_start", "window_end", "trend_json")
    newest = tables.windows.batch(spark, n).groupBy("adid").agg(F.max(value).alias("new"))
    before = tables.latest.current(spark, upto=n - 1).select("adid", value.alias("old"))
    # A late click's window does not take the place of a newer one.
    newer = F.when(F.col("old.window_start_ms") > F.col("new.window_start_ms"), F.col("old")).otherwise(F.col("new"))
    tables.latest.write(newest.join(before, "adid", "left").select("adid", newer.alias("v")).select("adid", "v.*"), n)


# --------------------------------------------------------------------------- J4
@dataclass
class BlacklistTables:
    counts: KeyedTable | None  # (day, userid, adid, clicks) summed over batches; None if in the state store
    bans: KeyedTable  # (userid) set
    accepted: KeyedTable | None  # accepted click rows, one partition per batch


def start_blacklist(
    clicks: DataFrame,
    root: str,
    threshold: int = DEFAULT_THRESHOLD,
    keep_accepted: bool = True,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    compact_every: int = DEFAULT_COMPACT_EVERY,
    name: str = "ads_blacklist",
    state: str = "deltas",
    ttl_ms: int | None = None,
    tiebreak: str | None = None,
    quarantine: str | None = None,
) -> tuple[StreamingQuery, BlacklistTables]:
    """Dynamic blacklist. Per batch N: drop clicks of users banned in batches < N (the
    blacklist is read once per batch, so later clicks in the same batch still count);
    add the batch's per-(day, user, ad) counts; ban every user whose total for a
    touched key is strictly above ``threshold``. Bans are permanent and cover all ads.

    The ban set may grow with the user base, so it is joined without a broadcast hint:
    AQE picks a broadcast when its measured size is small.

    ``state="store"`` keeps each user's counts and ban in the state store instead
    (``BanProcessor``): a batch costs the users it holds, not its days, and bans act from the
    click that earns them. If clicks arrive in the order of time and ``tiebreak`` (default:
    ``event_id`` where there is one), the accepted clicks are those of ``accepted_clicks``.
    ``ttl_ms`` forgets counts that got no click for so long.
    """
    if state not in ("deltas", "store") or (state == "deltas" and ttl_ms is not None):
        raise ValueError("state must be 'deltas' or 'store'; ttl_ms belongs to state='store'")
    _no_quarantine_with(state, quarantine)
    if state == "store":
        return _start_blacklist_store(
            clicks, root, threshold, trigger, checkpoint, compact_every, name, ttl_ms, tiebreak
        )
    spark = clicks.sparkSession
    counts = KeyedTable(
        f"{root}/counts", "day STRING, userid STRING, adid STRING, clicks BIGINT",
        keys=["day", "userid", "adid"], kind="sum", compact_every=compact_every, partition_by="day",
    )
    bans = KeyedTable(f"{root}/bans", "userid STRING", keys=["userid"], kind="set", compact_every=compact_every)
    accepted_cols = [c for c in clicks.columns if c not in ("ts", "malformed")]
    accepted = None
    if keep_accepted:
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in clicks.schema.fields if f.name in accepted_cols)
        accepted = KeyedTable(f"{root}/accepted", schema, keys=accepted_cols, kind="append")
    tables = BlacklistTables(counts, bans, accepted)
    for t in (counts, bans, accepted):
        if t is not None:
            t.ensure(spark)

    body = blacklist_body(tables, threshold, accepted_cols)
    return _start(clicks, name, body, "append", trigger, checkpoint, quarantine), tables


def _start_blacklist_store(clicks, root, threshold, trigger, checkpoint, compact_every, name, ttl_ms, tiebreak):
    spark = clicks.sparkSession
    fields = [f for f in clicks.schema.fields if f.name != "ts"]
    columns = [f.name for f in fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", bans BOOLEAN"
    accepted = KeyedTable(f"{root}/accepted", schema, keys=[*columns, "bans"], kind="append")
    bans = KeyedTable(f"{root}/bans", "userid STRING", keys=["userid"], kind="set", compact_every=compact_every)
    for t in (accepted, bans):
        t.ensure(spark)
    if tiebreak is None and "event_id" in columns:
        tiebreak = "event_id"
    processor = BanProcessor(threshold, columns, ["ts_ms", *([tiebreak] if tiebreak else [])], ttl_ms)
    passed = clicks.select(*columns).groupBy("userid").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )

    def body(df: DataFrame, n: int) -> None:
        accepted.write(df, n)
        bans.write(accepted.batch(spark, n).filter("bans").select("userid"), n)

    return _start(passed, name, body, "append", trigger, checkpoint), BlacklistTables(None, bans, accepted)


def blacklist_body(tables: BlacklistTables, threshold: int, accepted_cols: list[str]):
    """The per-batch body of the blacklist stream (exposed for replay tests)."""
    counts, bans, accepted = tables.counts, tables.bans, tables.accepted

    def body(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        banned = bans.current(spark, upto=n - 1)
        kept = df.join(banned, "userid", "left_anti")
        if accepted is not None:
            accepted.write(kept.select(*accepted_cols), n)
            kept = accepted.batch(spark, n)
        counts.write(user_ad_daily_clicks(kept), n)
        touched = counts.batch(spark, n).select("day", "userid", "adid")
        days = counts.partitions_of(spark, n) if counts.partition_by else None
        totals = counts.current(spark, upto=n, partitions=days).join(touched, ["day", "userid", "adid"], "left_semi")
        bans.write(over_threshold(totals, threshold), n)

    return body


def start_console_preview(df: DataFrame, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """K7: print each micro-batch (debugging; no checkpoint is kept)."""
    return df.writeStream.format("console").outputMode(mode).trigger(**(trigger or DEFAULT_TRIGGER)).start()
