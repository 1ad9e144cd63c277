"""Mixing sources to target weights, block by block.

The words of each source are laid end to end (documents in a fixed pseudorandom order)
and cut into blocks of ``block_words`` words; the last block of a source may be short.
The mix has ``shards`` output shards. Each shard draws the sources of its slots from a
multinomial whose probabilities are the slots each source still has to fill, so that a
source's slots add up to its target exactly. The slots of a source are numbered through
all shards and mapped to its blocks by pseudorandom permutations of the block numbers,
one permutation for each pass over the source; slots then join blocks by number.

Sources in code point order (null last) weigh ``weights``, repeating. Targets add up to
the size of the corpus; a target stops at ``most`` times its source's size and the excess
goes to the others by weight, until none is above. Whole passes take every word of a
source once, so a source's words differ from its target by at most one block, and no
document is taken more than ``most`` times.

The driver holds one row per source and per (shard, source); sources are a corpus's
catalogue, not its documents. A hot source is spread by sub-bucket and by block number.

Defined results: a null text has no words; a null source is a source; documents without
words take part with ``taken`` 0; repeated rows are documents of their own; an empty
table, or one without words, gives no slots. Reruns agree for equal inputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import placed, small_batches
from clickflow.llm.words import U64, Texts, mix, seeded, text_blocks

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SHARDS = 64
SEED = 20240229
SLOTS_AT_ONCE = 1 << 18
#: Slots that one task makes, beyond the first 16 tasks.
SLOTS_OF_A_TASK = 1 << 21


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """The target of each source, in order."""
    weight = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    size = np.array(sizes, float)
    out, free, left = np.zeros(len(sizes)), size > 0, float(size.sum())
    while free.any():
        share = left * weight / weight[free].sum()
        above = free & (share > most * size)
        if not above.any():
            out[free] = share[free]
            break
        out[above] = most * size[above]
        left -= float(out[above].sum())
        free &= ~above
    return out.tolist()


@dataclass
class Plan:
    """Sources in order, with sizes, targets, numbers of blocks and of slots."""

    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    blocks: list[int]
    slots: list[int]
    rows: int


def plan_mix(sized: DataFrame, block_words: int) -> Plan:
    """``sized``: source, size. One row per source comes to the driver."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    goal = targets(sizes)
    blocks, slots = [], []
    for size, target in zip(sizes, goal, strict=True):
        n = -(-size // block_words)
        passes = int(target // size) if size else 0
        rest = min(n, round((target - passes * size) / block_words))
        blocks.append(n)
        slots.append(passes * n + rest)
    return Plan([r["source"] for r in rows], sizes, goal, blocks, slots, sum(r["n"] for r in rows))


def draw_counts(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source (columns) in each shard (rows)."""
    left = np.array(slots, np.int64)
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((shards, len(slots)), np.int64)
    for shard in range(shards):
        room = int(left.sum()) // (shards - shard)
        while room:
            drawn = np.minimum(rng.multinomial(room, left / left.sum()), left)
            out[shard] += drawn
            left -= drawn
            room -= int(drawn.sum())
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The images of ``index`` under a pseudorandom permutation of 0..n-1: a four-round
    Feistel network on the next power of four, followed until it falls below ``n``."""
    half = U64(max(1, ((n - 1).bit_length() + 1) // 2))
    low = U64((1 << int(half)) - 1)
    keys = seeded(key, 4)
    out = index.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def _slots(spark, plan: Plan, shards: int, seed: int) -> DataFrame:
    """(shard, source_no, slot, block, pass) of every slot of the mix."""
    counts = draw_counts(plan.slots, shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    runs = [
        (shard, s, int(first[shard, s]), int(first[shard, s] + counts[shard, s]))
        for shard in range(shards)
        for s in range(len(plan.slots))
        if counts[shard, s]
    ]
    # Long runs are cut, so that slots spread over tasks however few shards there are.
    table = spark.createDataFrame(runs, "shard int, source_no int, _from long, _end long")
    table = table.withColumn("at", F.explode(F.sequence("_from", F.col("_end") - 1, F.lit(SLOTS_AT_ONCE).cast("long"))))
    table = table.select("shard", "source_no", "at", F.least(F.lit(SLOTS_AT_ONCE).cast("long"), F.col("_end") - F.col("at")).alias("n"))
    tasks = max(16, math.ceil(sum(plan.slots) / SLOTS_OF_A_TASK))
    blocks = plan.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, s, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slot = np.arange(at, at + n)
                passes, index = np.divmod(slot, blocks[s])
                block = np.empty(n, np.int64)
                for p in np.unique(passes):
                    inside = passes == p
                    block[inside] = permuted(index[inside], blocks[s], seed + 1000003 * s + int(p))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(np.full(n, s, np.int32)),
                        pa.array(slot),
                        pa.array(block),
                        pa.array(passes.astype(np.int32)),
                    ],
                    ["shard", "source_no", "slot", "block", "pass"],
                )

    return table.repartition(tasks, "shard", "source_no", "at").mapInArrow(
        run, "shard int, source_no int, slot long, block long, pass int"
    )


def _pieces(sized: DataFrame, plan: Plan, block_words: int) -> DataFrame:
    """Each document's share of each block it lies in: block, from, words. Documents
    without words have one row with a null block."""
    numbers = sized.sparkSession.createDataFrame(
        [(s, i, n, t) for i, (s, n, t) in enumerate(zip(plan.sources, plan.sizes, plan.targets, strict=True))],
        "source string, source_no int, source_size long, target double",
    )
    known = sized.join(
        numbers.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    order = [F.col(c) for c in ("doc_id", "size", "_k1", "_k2")]
    laid = placed(known, ["source_no"], F.col("size"), order, "start", plan.rows)
    size, start = F.col("size"), F.col("start")
    last = F.floor((start + size - 1) / block_words)
    blocks = F.when(size > 0, F.sequence(F.floor(start / block_words), last))
    lo = F.greatest(F.col("block") * block_words, start)
    hi = F.least((F.col("block") + 1) * block_words, start + size)
    return (
        laid.withColumn("block", F.explode_outer(blocks))
        .withColumn("from", lo - start)
        .withColumn("words", hi - lo)
    )


def _row_key(docs: DataFrame, names: list[str]) -> dict[str, Column]:
    """128 bits that stand for a row's values of some columns, nulls included."""
    parts = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in names]
    nulls = [docs[c].isNull() for c in names]
    return {"_k1": F.xxhash64(*parts, *nulls), "_k2": F.xxhash64(*nulls, *parts[::-1])}


def mix_sources(
    docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``: its slots (shard, source_no, slot, block, pass), and the pieces
    of documents (doc_id, source_no, size, start, block, from, words, ...) that blocks hold."""
    docs = docs.select("doc_id", "source", "text")
    keyed = docs.withColumns(_row_key(docs, docs.columns))
    sized = keyed.select("doc_id", "source", word_count(F.col("text")).alias("size"), "_k1", "_k2")
    plan = plan_mix(sized, block_words)
    return _slots(docs.sparkSession, plan, shards, seed), _pieces(sized, plan, block_words)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes."""
    slots, pieces = mix_sources(docs, **options)
    # Without the hint the planner takes slots for as few as the runs they come from, and
    # broadcasts them.
    times = slots.groupBy("source_no", "block").agg(F.count("*").alias("times")).hint("merge")
    return (
        pieces.join(times, ["source_no", "block"], "left")
        .groupBy("source_no", "doc_id", "size", "_k1", "_k2", "start", "source_size", "target")
        .agg(
            # Equal rows without words share a place; each is a row of its own.
            F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken"),
            F.sum(F.when(F.col("size") == 0, 1).otherwise(0)).alias("_rows"),
        )
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_rows"), F.lit(1)))))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row per document and pass, whose
    text is what that pass takes of it (word ranges of whole blocks, in order, each as
    written; ranges that do not touch are set apart by a newline). ``n_chars`` is renewed."""
    slots, pieces = mix_sources(docs, **options)
    row = ["_k1", "_k2"]
    takes = (
        pieces.where("size > 0")
        .join(slots.select("source_no", "block", "pass").hint("merge"), ["source_no", "block"])
        .groupBy(*row, "start", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("from", "words"))).alias("ranges"))
        .groupBy(*row, "start")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "ranges"))).alias("passes"))
        .groupBy(*row)
        .agg(F.array_sort(F.collect_list(F.struct("start", "passes"))).alias("places"))
    )
    # Equal rows lie at different places; the i-th of them gets the i-th place. Columns go by
    # number meanwhile, so that no name of theirs can clash.
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    names = [f"c{columns.index(c)}" for c in ("doc_id", "source", "text")]
    turn = Window.partitionBy(*row).orderBy(F.lit(0))
    rows = numbered.withColumns(_row_key(numbered, names)).withColumn("_turn", F.row_number().over(turn))
    place = F.get("places", F.col("_turn") - 1)
    joined = rows.join(takes, row).withColumn("takes", place["passes"]["ranges"]).where("takes is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut(batch, columns)

    return small_batches(joined.select(*numbered.columns, "takes")).mapInArrow(cut, docs.schema)


def _cut(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_blocks(batch, f"c{columns.index('text')}"):
        takes = rows.column(rows.schema.get_field_index("takes")).to_pylist()
        at, out = [], []
        for i, passes in enumerate(takes):
            for ranges in passes:
                at.append(i)
                out.append(_text(texts, i, ranges))
        taken = rows.select([f"c{i}" for i in range(len(columns))]).take(pa.array(at, pa.int64()))
        arrays = list(taken.columns)
        k = columns.index("text")
        arrays[k] = pa.array(out, taken.schema.field(k).type)
        if "n_chars" in columns:
            k = columns.index("n_chars")
            arrays[k] = pa.array([len(t) for t in out], taken.schema.field(k).type)
        yield pa.RecordBatch.from_arrays(arrays, columns)


def _text(texts: Texts, i: int, ranges: list[dict]) -> str:
    first, end = texts.first[i], texts.first[i + 1]
    parts: list[tuple[int, int]] = []
    for r in ranges:
        lo, hi = int(first + r["from"]), int(first + r["from"] + r["words"])
        if parts and parts[-1][1] == lo:
            parts[-1] = (parts[-1][0], hi)
        else:
            parts.append((lo, hi))
    if parts == [(int(first), int(end))]:
        return texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes().decode()
    return "\n".join(texts.data[texts.starts[lo] : texts.ends[hi - 1]].tobytes().decode() for lo, hi in parts)
