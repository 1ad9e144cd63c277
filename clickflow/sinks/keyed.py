"""K4-K6: replay-safe keyed tables written from ``foreachBatch``.

The original jobs kept results in Redis hashes and sets (HSET, HINCRBY, SADD), which
repeat on a task retry and cannot be rebuilt. Here every micro-batch ``N`` writes its
rows to its own folder ``batch_id=N`` with overwrite, so a replayed batch replaces
exactly what it wrote before. Keys are real columns, never concatenated strings.

Reading "as of N" merges the rows of all batches up to N:

* ``latest`` (HSET): per key, the values of the newest batch that wrote the key. A
  key not written by a batch keeps its previous value.
* ``sum`` (HINCRBY): per key, the sum of the deltas.
* ``set`` (SADD / SMEMBERS): the distinct keys.
* ``append``: every row of every batch (an output log, e.g. accepted clicks).

With ``partition_by`` (e.g. ``day``), batches and snapshots are also partitioned by that key
column, and readers may name the values they need.

Every ``compact_every`` batches the merged state goes into a snapshot ``_snapshots/upto=N``:
of a partitioned table only the partitions that changed since the last one. Snapshots are
found by listing those that completed, not by a schedule, so ``compact_every`` may change
between runs. What a snapshot covers is retired at the next one: batch folders older than
the previous snapshot, and older copies of its partitions. A reader opens the newest copy
of each partition and the batch folders after it, all by path, so what a batch lists and
reads does not grow with the age of the stream. ``append`` tables are never compacted or
retired; a batch reads its own folder only.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("latest", "sum", "set", "append")


class KeyedTable:
    def __init__(
        self,
        path: str,
        schema: T.StructType | str,
        keys: Sequence[str],
        kind: str = "latest",
        compact_every: int = 0,
        partition_by: str | None = None,
    ) -> None:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys = list(keys)
        self.values = [f.name for f in self.schema.fields if f.name not in self.keys]
        if kind == "set" and self.values:
            raise ValueError("a set table has key columns only")
        self.kind = kind
        self.compact_every = 0 if kind == "append" else compact_every
        if partition_by is not None and partition_by not in self.keys:
            raise ValueError("partition_by must be a key column")
        self.partition_by = partition_by
        self._full = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])

    # ------------------------------------------------------------------ layout
    def _batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def _snapshots_path(self) -> str:
        return f"{self.path}/_snapshots"

    def _list(self, spark: SparkSession, path: str) -> list[str]:
        """Names in a folder (none if it is missing), through Hadoop's file system API."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _retire(self, spark: SparkSession, path: str) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def snapshots(self, spark: SparkSession) -> list[int]:
        """Completed snapshots, oldest first."""
        names = [n for n in self._list(spark, self._snapshots_path()) if n.startswith("upto=")]
        done = [n for n in names if "_SUCCESS" in self._list(spark, f"{self._snapshots_path()}/{n}")]
        return sorted(int(n[len("upto="):]) for n in done)

    def _batches(self, spark: SparkSession) -> list[int]:
        names = self._list(spark, self.path)
        return sorted(int(n[len("batch_id="):]) for n in names if n.startswith("batch_id="))

    def _parts(self, spark: SparkSession, path: str) -> list[str]:
        """Partition folder names below a batch or snapshot folder."""
        return [n for n in self._list(spark, path) if n.startswith(f"{self.partition_by}=")]

    # ------------------------------------------------------------------ writes
    def _save(self, df: DataFrame, path: str) -> None:
        if self.partition_by is not None:
            # Few files per partition value; AQE splits a hot value over several tasks.
            df = df.hint("rebalance", self.partition_by)
        writer = df.write.mode("overwrite")
        if self.partition_by is not None:
            writer = writer.partitionBy(self.partition_by)
        writer.parquet(path)

    def ensure(self, spark: SparkSession) -> None:
        """Create the table, so that reads work before the first batch. Idempotent."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Overwrite batch ``batch_id`` with ``df`` (keys and values, by name)."""
        spark = df.sparkSession
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        self._save(df.select(*cols), self._batch_path(batch_id))
        if self.compact_every > 0 and (batch_id + 1) % self.compact_every == 0:
            self._compact(spark, batch_id)

    def _compact(self, spark: SparkSession, upto: int) -> None:
        # Built from the snapshot before, never from the one being written.
        done = [s for s in self.snapshots(spark) if s < upto]
        last = done[-1] if done else -1
        batches = [b for b in self._batches(spark) if last < b <= upto]
        parts = None
        if self.partition_by is not None:
            parts = {p for b in batches for p in self.partitions_of(spark, b)}
        state = self._merge(self._rows(spark, upto, last, parts))
        self._save(state, f"{self._snapshots_path()}/upto={upto}")
        # The last batch may be replayed, which reads the state before it: ``last`` and the
        # batches after it stay until the next snapshot.
        for b in self._batches(spark):
            if b <= last:
                self._retire(spark, self._batch_path(b))
        if self.partition_by is None:
            for s in done[:-1]:
                self._retire(spark, f"{self._snapshots_path()}/upto={s}")
            return
        kept: set[str] = set()
        for s in reversed(done):
            folder = f"{self._snapshots_path()}/upto={s}"
            here = self._parts(spark, folder)
            old = [p for p in here if p in kept]
            for p in old:
                self._retire(spark, f"{folder}/{p}")
            if s != last and len(old) == len(here):
                self._retire(spark, folder)
            kept |= set(here)

    # ------------------------------------------------------------------ reads
    def _read(self, spark: SparkSession, base: str, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _rows(self, spark: SparkSession, upto: int | None, snap: int, parts: set[str] | None = None) -> DataFrame:
        """Rows of the newest copy of each partition up to snapshot ``snap`` and of the batches
        after it, with batch ids; of the partition values ``parts`` only, unless None."""

        def wanted(folder: str) -> bool:
            return parts is None or unquote(folder.partition("=")[2]) in parts

        batches = [b for b in self._batches(spark) if b > snap and (upto is None or b <= upto)]
        names = self._full.fieldNames()
        deltas = [self._batch_path(b) for b in batches]
        if parts is not None:
            deltas = [f"{d}/{p}" for d in deltas for p in self._parts(spark, d) if wanted(p)]
        rows = self._read(spark, self.path, deltas, self._full).select(*names)
        if snap < 0:
            return rows
        if self.partition_by is None:
            copies = [f"{self._snapshots_path()}/upto={snap}"]
        else:
            newest: dict[str, str] = {}
            for s in self.snapshots(spark):
                if s <= snap:
                    folder = f"{self._snapshots_path()}/upto={s}"
                    newest |= {p: f"{folder}/{p}" for p in self._parts(spark, folder)}
            copies = [f for p, f in sorted(newest.items()) if wanted(p)]
        return self._read(spark, self._snapshots_path(), copies, self._full).select(*names).unionByName(rows)

    def _merge(self, rows: DataFrame) -> DataFrame:
        if self.kind == "append":
            return rows
        if self.kind == "set":
            return rows.groupBy(*self.keys).agg(F.min("batch_id").alias("batch_id"))
        if self.kind == "sum":
            aggs = [F.sum(v).cast(self.schema[v].dataType).alias(v) for v in self.values]
            return rows.groupBy(*self.keys).agg(*aggs, F.max("batch_id").alias("batch_id"))
        newest = F.max_by(F.struct(*self.values, "batch_id"), F.col("batch_id")).alias("_v")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_v.*")

    def current(
        self,
        spark: SparkSession,
        upto: int | None = None,
        with_batch_id: bool = False,
        partitions: Sequence[str] | None = None,
    ) -> DataFrame:
        """Merged state after batch ``upto`` (all batches when None), optionally only for the
        given values of the ``partition_by`` column: other folders are not opened."""
        if partitions is not None and self.partition_by is None:
            raise ValueError("table has no partition column")
        wanted = None if partitions is None else {str(p) for p in partitions}
        snaps = [s for s in self.snapshots(spark) if upto is None or s <= upto]
        state = self._merge(self._rows(spark, upto, snaps[-1] if snaps else -1, wanted))
        return state if with_batch_id else state.drop("batch_id")

    def partitions_of(self, spark: SparkSession, batch_id: int) -> list[str]:
        """Values of the ``partition_by`` column that a batch wrote, told from its folder."""
        return [unquote(p.partition("=")[2]) for p in self._parts(spark, self._batch_path(batch_id))]

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows written by one batch, read from its own folder."""
        rows = self._read(spark, self.path, [self._batch_path(batch_id)], self._full)
        return rows.select(*[f.name for f in self.schema.fields])
