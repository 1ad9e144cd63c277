"""Sharding along a Hilbert curve.

Each document gets coordinates from its metadata: a length rank (sixteenths of the
corpus by text bytes), its source and its language, each quantised to ``2 ** BITS`` steps;
names get theirs by rank in code point order, so that a file's range of names is narrow.
The cell's index along the Hilbert curve orders the corpus, so that neighbours on the curve
are alike in every dimension, and runs of the curve are the shards: each shard's files
cover few values of every dimension, and a reader's filters skip the others.

The position of a document is a sum of counts: cells before its cell, sub-buckets of its
cell before its own, and documents before it in its sub-bucket. The cells are at most
``2 ** (3 * BITS)``; sub-buckets spread a cell that holds a large part of all rows. Only
DataFrame functions are used.

Defined results: a null text counts 0 bytes (size 1, crc32 of no bytes); null sources and
languages share a step of their own; equal rows take neighbouring slots; an empty table
gives an empty result; extra columns are ignored. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import placed

SHARDS = 16
BITS = 4
DIMS = 3


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _trailing_ones(i: int) -> int:
    return ((~i) & (i + 1)).bit_length() - 1


def curve_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """The index of a cell along the Hilbert curve, most significant bits first.

    Level by level, the level's bits name a corner of the current subcube; rotated and
    reflected into the subcube's frame they are a Gray code whose rank is the next digit of
    the index, and the rank fixes the frame of the level below.
    """
    n = len(coordinates)
    ranks = range(2**n)
    rank_of = F.array(*[F.lit(next(w for w in ranks if _gray(w) == g)) for g in ranks])
    entry = F.array(*[F.lit(_gray(2 * ((w - 1) // 2)) if w else 0) for w in ranks])
    turn = F.array(
        *[F.lit(0 if w == 0 else _trailing_ones(w - 1 if w % 2 == 0 else w) % n) for w in ranks]
    )
    low = F.lit(2**n - 1)

    def rotated(x: Column, by: Column, left: bool) -> Column:
        # ``by`` takes n values, so the rotation is a choice among n constant shifts.
        out = x
        for k in range(1, n):
            up, down = (k, n - k) if left else (n - k, k)
            here = F.shiftleft(x, up).bitwiseOR(F.shiftright(x, down)).bitwiseAND(low)
            out = F.when(by % n == k, here).otherwise(out)
        return out

    corners = F.array(
        *[
            sum(
                (F.shiftleft(F.shiftright(c, level).bitwiseAND(F.lit(1)), d) for d, c in enumerate(coordinates[1:], 1)),
                F.shiftright(coordinates[0], level).bitwiseAND(F.lit(1)),
            )
            for level in reversed(range(bits))
        ]
    )

    def step(state: Column, corner: Column) -> Column:
        by = state["turn"] + 1
        rank = F.get(rank_of, rotated(corner.bitwiseXOR(state["entry"]), by, left=False))
        return F.struct(
            (state["index"] * (2**n) + rank).alias("index"),
            state["entry"].bitwiseXOR(rotated(F.get(entry, rank), by, left=True)).alias("entry"),
            ((by + F.get(turn, rank)) % n).alias("turn"),
        )

    start = F.struct(F.lit(0).alias("index"), F.lit(0).alias("entry"), F.lit(0).alias("turn"))
    return F.aggregate(corners, start, step, lambda s: s["index"])


#: Characters that tell names apart, after what all names begin with.
NAME_CHARS = 7


def _name_key(name: Column, skip: int) -> Column:
    """A number that orders names by code point, from ``NAME_CHARS`` bytes after the first
    ``skip`` characters; null for null."""
    rest = F.substring(F.hex(F.encode(F.substr(name, F.lit(skip + 1)), "UTF-8")), 1, 2 * NAME_CHARS)
    return F.conv(F.rpad(rest, 2 * NAME_CHARS, "0"), 16, 10).cast("long")


def _with_steps(rows: DataFrame, name: str, steps: int, out: str) -> DataFrame:
    """``rows`` with ``out``, the steps of the column's names by their rank among all its names in
    code point order, so that neighbours on the curve have neighbouring names; null to step 0.
    Names meet in partial aggregation; the driver gets two names and ``steps - 2`` numbers."""
    names = rows.select(F.col(name).alias("name")).where("name is not null").groupBy("name").agg(F.lit(1).alias("one"))
    ends = names.agg(F.min("name").alias("a"), F.max("name").alias("b")).first()
    a, b = ends["a"] or "", ends["b"] or ""
    skip = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    key = _name_key(F.col("name"), skip)
    parts = [i / (steps - 1) for i in range(1, steps - 1)]
    edges = names.agg(F.percentile_approx(key, parts, 10_000)).first()[0] or []
    # Columns of their own, so that the key and the rank are worked out once a row. Equal edges
    # count together, so few names spread over all steps.
    keyed = rows.withColumn(out, _name_key(F.col(name), skip))
    rank = sum((F.when(F.col(out) > edge, 1).otherwise(0) for edge in edges), F.lit(1))
    return keyed.withColumn(out, rank * F.col(out).isNotNull().cast("int"))


def with_cells(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32`` and ``cell``, their cell's index along the curve."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = docs.columns
    rows = docs.withColumn("size", (F.octet_length(text) + 1).cast("long")).withColumn(
        "text_crc32", F.crc32(text.cast("binary"))
    )
    made = [f"_step{i}" + "_" * max(map(len, held)) for i in range(DIMS)]
    steps = 2**bits
    # steps - 1 numbers, whatever the corpus.
    edges = rows.agg(F.percentile_approx("size", [i / steps for i in range(1, steps)], 10_000)).first()[0] or []
    rank = sum((F.when(F.col("size") > edge, 1).otherwise(0) for edge in edges), F.lit(0))
    rows = rows.withColumn(made[0], rank)
    for name, out in zip(("source", "lang"), made[1:], strict=True):
        rows = _with_steps(rows, name, steps, out)
    return rows.withColumn("cell", curve_index([F.col(c) for c in made], bits)).drop(*made)


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, bits: int = BITS, columns: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``columns`` of every row with size, text_crc32, cell, shard and slot, by the law
    ``rows``: shards are runs of the curve whose counts differ by at most one."""
    made = ["size", "text_crc32", "cell"]
    rows = with_cells(docs, bits).select(*columns, *made)
    # At most 2 ** (bits * DIMS) rows, one for each cell; one task orders them.
    cells = rows.groupBy("cell").agg(F.count("*").alias("n"))
    total = int(cells.agg(F.sum("n")).first()[0] or 0)
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(F.col("cell").alias("_cell"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    order = [F.col(c) for c in (*columns, *made) if c != "text"]
    inside = placed(rows, ["cell"], F.lit(1), order, "_place", total)
    at = inside.join(F.broadcast(bases), F.col("cell") == F.col("_cell")).withColumn(
        "_at", F.col("_first") + F.col("_place")
    )
    # Shard k holds the positions from ceil(k * total / shards) on.
    return (
        at.withColumn("_shard", F.expr(f"_at * {shards} div {max(total, 1)}L"))
        .withColumn("_from", F.expr(f"(_shard * {total}L + {shards - 1}) div {shards}"))
        .select(*columns, *made, F.col("_shard").cast("int").alias("shard"), (F.col("_at") - F.col("_from")).alias("slot"))
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> None:
    """Writes whole documents as Parquet, one folder per shard, in curve order inside files,
    so that footers' ranges of every dimension are narrow. A large shard is written by several
    tasks, each a run of its slots. Columns of ``docs`` with the names of the shards' own
    (size, text_crc32, cell, shard, slot) are written as ``doc_`` and their name."""
    own = ("size", "text_crc32", "cell", "shard", "slot")
    docs = docs.withColumnsRenamed({c: f"doc_{c}" for c in docs.columns if c in own})
    placed_rows = shard_rows(docs, shards, bits, tuple(docs.columns))
    (
        placed_rows.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
