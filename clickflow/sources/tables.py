"""Scan the click-log table and pin it to the declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.schemas import USER_VISIT_ACTION
from clickflow.sinks.tables import DAY_COL


def read_actions(
    spark: SparkSession,
    table: str | None = "user_visit_action",
    path: str | None = None,
    database: str | None = None,
) -> DataFrame:
    """Catalog table (optionally in ``database``) or a parquet path, typed.

    Only a projection is built here; Catalyst prunes the columns each job does not
    use and pushes the time-range predicate into the scan.
    """
    if path is not None:
        df = spark.read.parquet(path)
    else:
        name = f"{database}.{table}" if database else table
        df = spark.table(name)
    # A tie-break id, and the partition column of a published log, are carried along.
    return as_actions(df, keep=[c for c in ("event_id", DAY_COL) if c in df.columns])


def as_actions(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Select the click-log columns by name and cast them to the declared types.

    ``keep`` names extra columns to carry along (for instance a tie-break id).
    A missing column fails at analysis time, as a typed-row conversion would.
    """
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in USER_VISIT_ACTION.fields]
    extra = [F.col(c) for c in (keep or [])]
    return df.select(*extra, *cols)


def actions_from_rows(spark: SparkSession, rows: list[tuple], keep_schema: str | None = None) -> DataFrame:
    """Local rows (in ``USER_VISIT_ACTION`` column order, with optional leading
    ``keep_schema`` columns) -> a typed DataFrame. For fixtures and small lookups only:
    the rows travel through the driver."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in USER_VISIT_ACTION.fields)
    return spark.createDataFrame(rows, f"{keep_schema}, {schema}" if keep_schema else schema)
