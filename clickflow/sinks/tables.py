"""K1/K2: JDBC append; K3: publish a managed table; K7: console preview."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import closing
from itertools import islice
from typing import Any

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Partition column of a published click log: the day part of its time, nothing else.
DAY_COL = "action_day"


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Tag every result row with the run's task id (first column)."""
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    num_partitions: int | None = None,
    batch_size: int = 1000,
) -> None:
    """Append rows to a JDBC table, one connection per partition and batched inserts.

    ``num_partitions`` caps concurrent connections (coalesce, no shuffle). Rows are
    appended, as in the original jobs; a rerun or a retried task appends again (``write_once``
    does not). The JDBC driver jar must be on the
    classpath; no database is bundled or started here.
    """
    props = {"batchsize": str(batch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    df.write.mode("append").jdbc(url, table, properties=props)


def write_once(
    df: DataFrame,
    connect: Callable[[], Any],
    table: str,
    task_id: str,
    placeholder: str = "?",
    batch_size: int = 1000,
) -> None:
    """Append result rows, tagged with ``task_id``, to a database table so that each row is there
    once, whatever is retried or run again.

    ``connect`` opens a DB-API connection; tasks call it too. ``table`` has the column
    ``task_id`` before the columns of ``df``, and ``{table}_stage`` also ``part`` before them all.
    A task replaces the staged rows of its own partition in one transaction, so a retried or
    repeated attempt leaves what one attempt leaves. When all are staged, one transaction
    replaces the run's rows in ``table``: readers see none or all of them. A run that failed
    is run again under the same ``task_id``.
    """
    stage, columns = f"{table}_stage", ["task_id", *df.columns]
    with closing(connect()) as link:
        link.cursor().execute(f"DELETE FROM {stage} WHERE task_id = {placeholder}", (task_id,))
        link.commit()
    df.foreachPartition(
        lambda rows: stage_partition(rows, connect, stage, task_id, TaskContext.get().partitionId(), columns, placeholder, batch_size)
    )
    names = ", ".join(columns)
    with closing(connect()) as link:
        cursor = link.cursor()
        cursor.execute(f"DELETE FROM {table} WHERE task_id = {placeholder}", (task_id,))
        cursor.execute(f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} WHERE task_id = {placeholder}", (task_id,))
        cursor.execute(f"DELETE FROM {stage} WHERE task_id = {placeholder}", (task_id,))
        link.commit()


def stage_partition(
    rows: Iterable, connect: Callable[[], Any], stage: str, task_id: str, part: int, columns: list[str], placeholder: str, batch_size: int
) -> None:
    """Replace the staged rows of one partition, in one transaction."""
    names, marks = ", ".join(["part", *columns]), ", ".join([placeholder] * (len(columns) + 1))
    rows = iter(rows)
    with closing(connect()) as link:
        try:
            cursor = link.cursor()
            cursor.execute(f"DELETE FROM {stage} WHERE task_id = {placeholder} AND part = {placeholder}", (task_id, part))
            while batch := [(part, task_id, *row) for row in islice(rows, batch_size)]:
                cursor.executemany(f"INSERT INTO {stage} ({names}) VALUES ({marks})", batch)
        except BaseException:
            link.rollback()
            raise
        link.commit()


def publish_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    day_of: str | None = None,
) -> None:
    """Replace a managed table (drop-and-create semantics) with ``df``.

    ``day_of`` names a time string; its first ten characters become the column ``DAY_COL``,
    which the table is then partitioned by, so that time-range jobs prune partitions. The
    rows are first rebalanced on the partition columns, so that each task writes few
    directories (not one small file per date per task); AQE splits a hot date over
    several tasks and merges small ones.
    """
    if day_of is not None:
        df = df.withColumn(DAY_COL, F.substring(day_of, 1, 10))
        partition_by = [DAY_COL, *(partition_by or [])]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows (a debugging aid; reads only what ``n`` rows need)."""
    df.show(n, truncate=False)
