"""The folder that driver and executors share, and counts spread over keys."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset (a local session), a
    temporary folder is set as checkpoint directory first."""
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not top:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickflow-"))
        top = context.getCheckpointDir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows may hold long texts, about to be sent to Python: where the session has
    Spark's default of 10,000 rows to an Arrow batch, it gets ``BATCH_ROWS``, as a batch is
    held whole by the JVM and by Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == "10000":
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: lineage ends there, and
    an executor's loss costs nothing that was written."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Sub-buckets into which the rows of a key are dealt before they are numbered.
BUCKETS = 4096


def placed(df: DataFrame, keys: list[str], size: Column, order: list[Column], name: str, rows: int) -> DataFrame:
    """``df`` with ``name``: the sum of ``size`` over the rows before it in its key's order.

    The rows of a key are dealt by a hash of ``order`` into sub-buckets, as many as leave
    about 1,000 rows (of ``rows`` in all) in each, at most ``BUCKETS``; sub-buckets are
    summed first, so no task orders a whole key and a hot key spreads like any other. The
    order is by sub-bucket, then ``order``, the same on every run.
    """
    n = max(1, min(BUCKETS, math.ceil(rows / 1000)))
    dealt = df.withColumn("_size", size.cast("long")).withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    sums = dealt.groupBy(*keys, "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
    )
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    dealt = dealt.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return (
        dealt.join(sums, same, "left")
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .select(*df.columns, name)
    )
