"""S3: streaming sources of ad-click lines.

* ``kafka``: one topic, ``startingOffsets=latest`` (as the original consumer), the
  checkpoint replaces consumer-group auto-commit. Needs the ``spark-sql-kafka-0-10``
  package on the classpath (not bundled; not exercised by the tests here). The
  (partition, offset) pair is kept as the arrival-order tie-break.
* ``text``: a directory of text files, one line per click.
* ``parquet``: a directory of parquet files with a ``line`` column and any extra
  columns (the tests carry ``event_id`` this way).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.operators.ads import with_day
from clickflow.sources.adslog import parse_ad_lines


def read_ad_lines_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    topic: str = "ads_log",
    bootstrap_servers: str | None = None,
    schema: str | T.StructType | None = None,
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame with a string column ``line`` (plus source columns)."""
    reader = spark.readStream
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        if not bootstrap_servers:
            raise ValueError("bootstrap_servers is required for kafka")
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
        )
        if not (options and "startingOffsets" in options):
            reader = reader.option("startingOffsets", "latest")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        try:
            raw = reader.load()
        except AnalysisException as e:
            if "Failed to find data source: kafka" not in str(e):
                raise
            raise RuntimeError(
                "the kafka source needs the spark-sql-kafka-0-10 package on the classpath, e.g. "
                f"spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:{spark.version}"
            ) from e
        return raw.select(
            F.col("value").cast("string").alias("line"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            # The broker's stamp is part of the record: a replay sees the same arrival.
            F.unix_millis("timestamp").alias("arrival_ms"),
        )
    if path is None:
        raise ValueError(f"path is required for {fmt}")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    if fmt == "text":
        return reader.text(path).withColumnRenamed("value", "line")
    if fmt == "parquet":
        return reader.schema(schema or "line STRING").parquet(path)
    raise ValueError(f"unknown stream format {fmt!r}")


def ad_clicks_stream(
    lines: DataFrame, mode: str = "fail", keep: list[str] | None = None, metrics: str | None = None
) -> DataFrame:
    """Parse a line stream into clicks with a ``day`` label (same parser as batch).
    With ``metrics="name"`` the line and malformed counts of every micro-batch are
    reported in ``query.lastProgress["observedMetrics"]["name"]``."""
    if keep is None:
        keep = [c for c in lines.columns if c != "line"]
    return with_day(parse_ad_lines(lines, "line", mode=mode, keep=keep, metrics=metrics))
