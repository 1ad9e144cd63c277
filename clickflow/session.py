"""SparkSession construction and shared settings."""

from __future__ import annotations

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every clickflow job assumes. They only fill in what the launch configuration
# (spark-submit, spark-defaults.conf) or an active session has not set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Labels (day, clock) are rendered in the session zone, like the JVM zone the original
    # jobs used; without a zone from the cluster or the caller it is UTC, not the machine's.
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column call in the JVM (for
    # error messages): several extra round trips per function, paid at plan build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming aggregation state (J5-J7) off the JVM heap, in RocksDB, with changelog
    # checkpoints: state of millions of keys neither fills the heap nor is re-uploaded
    # whole at every micro-batch. Fixed per checkpoint, hence a session default.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "clickflow",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session. ``master`` is left to spark-submit unless given. ``conf``
    is the caller's own choice and wins; ``DEFAULTS`` give way to what is already set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    if active is not None:
        given = set(active.conf.getAll)
    else:
        # Starts the JVM if need be (with the caller's settings, as driver memory counts
        # from its start) and reads what the launch gave it.
        own = SparkConf(loadDefaults=False)
        own.setAll(list((conf or {}).items()))
        SparkContext._ensure_initialized(conf=own)
        given = {key for key, _ in SparkConf().getAll()}
    defaults = {key: value for key, value in DEFAULTS.items() if key not in given}
    for key, value in {**defaults, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stream checkpoints.

    Read from ``spark.checkpoint.dir`` as configured by the cluster. Jobs never fall
    back to a machine-local temporary folder: on a cluster that would not survive the
    loss of an executor or the driver host.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(tests set a temporary one themselves)"
        )
    return root.rstrip("/")


def stream_checkpoint(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Checkpoint location of one streaming query: explicit, else under the shared root."""
    if location:
        return location
    base = spark.conf.get("spark.sql.streaming.checkpointLocation", None)
    if base:
        return f"{base.rstrip('/')}/{name}"
    return f"{checkpoint_root(spark)}/streams/{name}"
