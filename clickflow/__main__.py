"""Command line: one subcommand per job, for ``spark-submit`` or ``python -m clickflow``.

Batch jobs (J1-J3) read the click-log table (or a parquet path), tag rows with a task id
and append them to a JDBC table (``--jdbc-url``) or a parquet folder (``--output``), or
print them. Stream jobs (J4-J7) read ad lines from Kafka, a text folder or a parquet folder
and keep their keyed tables under ``--output``.

    python -m clickflow category-top --table user_visit_action --start 2024-01-05 \\
        --jdbc-url jdbc:mysql://db/analytics --jdbc-user u --jdbc-password p
    python -m clickflow page-jump-rate --path /data/uva --target-pages 1,2,3,4,5,6,7 --output /out/jump
    python -m clickflow ads-blacklist --source kafka --bootstrap-servers b:9092 --output /out/bl
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from clickflow.plans.jobs import run_category_session_top, run_category_top, run_page_jump_rate
from clickflow.plans.params import job_params
from clickflow.session import build_session
from clickflow.sinks.tables import preview, publish_table, write_jdbc

# Result tables of the original jobs (fixed names).
DEFAULT_TABLES = {
    "category-top": "category_top10",
    "session-top": "category_top10_session_count",
    "page-jump-rate": "pagejumprate",
}
# The columns those tables have; the jobs' further columns go along on request only.
RESULT_COLUMNS = {
    "category-top": ["task_id", "category_id", "click_count", "order_count", "pay_count"],
    "session-top": ["task_id", "category_id", "session_id", "click_count"],
    "page-jump-rate": ["task_id", "page_jump", "jump_rate"],
}


def _batch_args(p: argparse.ArgumentParser) -> None:
    src = p.add_mutually_exclusive_group()
    src.add_argument("--table", default="user_visit_action", help="catalog table (default user_visit_action)")
    src.add_argument("--path", help="parquet folder of the click log instead of a table")
    p.add_argument("--database", help="database of the table")
    p.add_argument("--start", help="inclusive lower bound on action_time (string compare)")
    p.add_argument("--end", help="inclusive upper bound on action_time (string compare)")
    p.add_argument("--conditions", help='condition JSON, e.g. {"startDate": "...", "targetPageFlow": "1,2"}')
    p.add_argument("--task-id", help="task id on every row (default: a fresh UUID)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-connections", type=int, help="most connections at once")
    p.add_argument("--extra-columns", action="store_true", help="keep columns the original result tables lack")
    p.add_argument("--output", help="parquet folder to append to (when no JDBC url)")


def _stream_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source", choices=["kafka", "text", "parquet"], default="kafka")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--topic", default="ads_log")
    p.add_argument("--input", help="folder of text or parquet line files")
    p.add_argument("--output", required=True, help="root folder of the job's keyed tables")
    p.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--trigger-seconds", type=int, default=5)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--malformed", choices=["fail", "drop"], default="fail")
    p.add_argument("--compact-every", type=int, default=50)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="clickflow")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("category-top", help="J1: top categories by clicks, orders, payments")
    _batch_args(p)
    p.add_argument("--top-n", type=int, default=10)
    p = sub.add_parser("session-top", help="J2: top sessions of each top category")
    _batch_args(p)
    p.add_argument("--top-n", type=int, default=10)
    p.add_argument("--sessions-per-category", type=int, default=10)
    p = sub.add_parser("page-jump-rate", help="J3: page-to-page jump rate along a flow")
    _batch_args(p)
    p.add_argument("--target-pages", help="comma list of page ids")
    p.add_argument("--include-zero", action="store_true")
    p.add_argument(
        "--parts", type=int, help="cut sessions larger than one of so many shares of the log (default: the shuffle partitions)"
    )
    p = sub.add_parser("ads-daily-clicks", help="J5: running clicks per day, province, city, ad")
    _stream_args(p)
    p.add_argument("--state", choices=["deltas", "store"], default="deltas", help="summing table or state store")
    p.add_argument("--watermark", help="with --state store: evict days this far behind; their late clicks are lost")
    p = sub.add_parser("ads-top", help="J6: top ads per day and province (JSON)")
    _stream_args(p)
    p.add_argument("--top-n", type=int, default=3)
    p.add_argument("--scope", choices=["day", "batch"], default="day")
    p = sub.add_parser("ads-trend", help="J7: per-ad click trend in sliding windows (JSON)")
    _stream_args(p)
    p.add_argument("--window-seconds", type=int, default=60)
    p.add_argument("--slide-seconds", type=int, default=10)
    p.add_argument("--bucket-seconds", type=int, default=10)
    p.add_argument("--twelve-hour", action="store_true", help="the original hh:mm:ss labels")
    p = sub.add_parser("ads-blacklist", help="J4: dynamic user blacklist")
    _stream_args(p)
    p.add_argument("--threshold", type=int, default=20)
    p = sub.add_parser("publish", help="K3: publish a parquet click log as a table partitioned by day")
    p.add_argument("--path", required=True)
    p.add_argument("--table", default="user_visit_action")
    for p in sub.choices.values():
        p.add_argument("--time-zone", help="session zone of day and clock labels (default: the cluster's, else UTC)")
    return ap


def _sink(args: argparse.Namespace):
    if args.jdbc_url:
        table = args.jdbc_table or DEFAULT_TABLES[args.job]
        columns = None if args.extra_columns else RESULT_COLUMNS[args.job]
        return lambda df: write_jdbc(
            df if columns is None else df.select(*columns),
            args.jdbc_url, table, args.jdbc_user, args.jdbc_password, args.jdbc_driver,
            num_partitions=args.jdbc_connections,
        )
    if args.output:
        return lambda df: df.write.mode("append").parquet(args.output)
    return lambda df: preview(df, 100)


def _run_batch(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    params = job_params(args.conditions) if args.conditions else {}
    common = dict(
        table=args.table,
        path=args.path,
        database=args.database,
        start=args.start if args.start is not None else params.get("start"),
        end=args.end if args.end is not None else params.get("end"),
        task_id=args.task_id,
        sink=_sink(args),
    )
    if args.job == "category-top":
        return run_category_top(spark, top_n=args.top_n, **common)
    if args.job == "session-top":
        return run_category_session_top(
            spark, top_n=args.top_n, sessions_per_category=args.sessions_per_category, **common
        )
    pages = args.target_pages or params.get("target_pages")
    if not pages:
        raise SystemExit("page-jump-rate needs --target-pages (or targetPageFlow in --conditions)")
    return run_page_jump_rate(
        spark, pages, include_zero=args.include_zero, parts=args.parts, **common
    )


def _run_stream(spark: SparkSession, args: argparse.Namespace):
    from clickflow.sources.streams import ad_clicks_stream, read_ad_lines_stream
    from clickflow.streaming import start_blacklist, start_click_trend, start_daily_clicks, start_province_top_ads

    schema = spark.read.parquet(args.input).schema if args.source == "parquet" else None
    lines = read_ad_lines_stream(
        spark, args.source, path=args.input, topic=args.topic,
        bootstrap_servers=args.bootstrap_servers, schema=schema,
    )
    clicks = ad_clicks_stream(lines, mode=args.malformed, metrics="ad_lines")
    trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds} seconds"}
    common = dict(trigger=trigger, checkpoint=args.checkpoint, compact_every=args.compact_every)
    out = args.output.rstrip("/")
    if args.job == "ads-daily-clicks":
        query, _ = start_daily_clicks(
            clicks, f"{out}/daily_clicks", state=args.state, watermark=args.watermark, **common
        )
    elif args.job == "ads-top":
        query, _ = start_province_top_ads(
            clicks, f"{out}/counts", f"{out}/top", args.top_n, scope=args.scope, **common
        )
    elif args.job == "ads-trend":
        query, _ = start_click_trend(
            clicks, out, args.window_seconds * 1000, args.slide_seconds * 1000, args.bucket_seconds * 1000,
            twelve_hour=args.twelve_hour, **common
        )
    else:
        query, _ = start_blacklist(clicks, out, threshold=args.threshold, **common)
    return query


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    zone = {"spark.sql.session.timeZone": args.time_zone} if args.time_zone else {}
    spark = spark or build_session(f"clickflow-{args.job}", conf=zone)
    if args.time_zone:
        spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    if args.job == "publish":
        publish_table(spark.read.parquet(args.path), args.table, day_of="action_time")
    elif args.job.startswith("ads-"):
        _run_stream(spark, args).awaitTermination()
    else:
        _run_batch(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
