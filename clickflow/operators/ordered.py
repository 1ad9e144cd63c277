"""Keys too large for one task, cut into runs of an order.

An ordered window over a key (``lead``, ``row_number``) needs the key's rows in one task.
``hot_cuts`` finds, from a uniform sample of a size set by the partitions, the keys that hold more rows than
a partition's share, and places in their order the points at which to cut them. A row's run
is a plain function of the row and these points, so any number of scans agree on it, and
results computed from runs and their edges do not depend on where the sample put the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows for each partition of the cut table.
SAMPLE_PER_PART = 32
RUN = "_run"


def hot_cuts(df: DataFrame, key: str, order: Sequence[str], parts: int | None = None) -> DataFrame | None:
    """(_key, _cuts) for every key of ``df`` that spans at least a whole partition's share of
    the rows, or None if there is none. ``_cuts`` are ``order`` structs, ascending; there are
    fewer than ``parts`` cuts in all (default: the session's shuffle partitions), so the
    result may be broadcast. Costs a row count (of footers, where nothing is filtered) and a
    scan of key and order, which returns about ``parts * SAMPLE_PER_PART`` rows; a table of no
    more rows than that has no hot key."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = parts * SAMPLE_PER_PART
    total = df.count()
    if parts < 2 or total <= size:
        return None
    fields = [df.schema[c] for c in order]
    sample = df.select(F.col(key).alias("_key"), F.struct(*order).alias("_at")).sample(size / total, seed=7)
    rows = sample.orderBy("_key", "_at").collect()
    picked = [rows[i * len(rows) // parts] for i in range(1, parts)] if len(rows) >= parts else []
    cuts: dict[object, dict[tuple, None]] = {}
    count: dict[object, int] = {}
    for row in picked:
        cuts.setdefault(row["_key"], {})[tuple(row["_at"])] = None
        count[row["_key"]] = count.get(row["_key"], 0) + 1
    # Between two cuts lies a whole share; keys with fewer fit a partition as they are.
    hot = [(k, list(at)) for k, at in cuts.items() if count[k] > 1]
    if not hot:
        return None
    at = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    schema = T.StructType([T.StructField("_key", df.schema[key].dataType), T.StructField("_cuts", T.ArrayType(at))])
    return spark.createDataFrame(hot, schema)


def with_runs(df: DataFrame, cuts: DataFrame | None, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``RUN``: null for rows of ordinary keys, for hot keys the number of cuts at
    or before the row. Rows of one place in the order share a run."""
    if cuts is None:
        return df.withColumn(RUN, F.lit(None).cast("int"))
    joined = df.join(F.broadcast(cuts), F.col(key).eqNullSafe(F.col("_key")), "left")
    before = F.size(F.filter("_cuts", lambda c: c <= F.struct(*order)))
    return joined.withColumn(RUN, F.when(F.col("_cuts").isNotNull(), before)).drop("_key", "_cuts")
