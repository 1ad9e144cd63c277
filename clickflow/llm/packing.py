"""Harmonic packing of token sequences.

A document's ids (with its end id) are cut into pieces: whole sequences of ``capacity``
first, then the rest. A piece of length L belongs to the class k with
capacity / (k + 1) < L <= capacity / k, and a bin of class k always holds k pieces. A rest
that would leave more than ``SLACK`` tokens of its share of a bin empty is cut: one piece
fills the share capacity / (k + 1) and the remainder, which is short, is treated alike. So bins
are nearly full by the cut alone, and filling needs nothing but a piece's number within
its class: each sub-bucket of a class numbers its own pieces from an offset that the
sub-buckets' counts give, on any number of workers, and a hot class spreads like any other.

Only the last, incomplete bin of each class differs: its pieces (fewer than k for each
class, a number that depends on ``CLASSES`` alone) are put together by first fit in
decreasing length.

Defined results: a null text is empty and has only its end id; equal rows are packed each;
an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import placed, small_batches, written
from clickflow.llm.token_ids import encoder
from clickflow.llm.words import text_blocks

CAPACITY = 1024
END_ID = 0
#: Tokens of its share of a bin that a piece may leave empty.
SLACK = 8
#: Pieces in a bin, by class: every number up to 32, then coarser steps for the short rests.
CLASSES = (*range(1, 33), 40, 48, 64, 80, 96, 128, 192, 256, 512, 1024)


def share(k: int, capacity: int = CAPACITY) -> int:
    return capacity // k


def class_of(length: int, capacity: int = CAPACITY) -> int:
    """The largest number of pieces of this length class that a bin holds."""
    return max(k for k in CLASSES if share(k, capacity) >= length)


def cuts(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = class_of(rest, capacity)
        if capacity / k - rest <= slack:
            pieces.append(rest)
            break
        smaller = share(CLASSES[CLASSES.index(k) + 1], capacity)
        pieces.append(smaller)
        rest -= smaller
    return pieces


_PIECES = "doc_id {}, start long, length int, ids_crc32 long, doc_tokens long, class int, h1 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, with the checksum of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        tails = [cuts(n, capacity) for n in range(capacity)]
        tail_classes = [[class_of(p, capacity) for p in t] for t in tails]
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for rows, texts in text_blocks(batch):
                ids, begins = encode(texts)
                of, start, length, crc, tokens, kind = [], [], [], [], [], []
                for i in range(len(rows)):
                    own = np.concatenate([ids[begins[i] : begins[i + 1]], end]).astype("<u4")
                    n, at = len(own), 0
                    raw = memoryview(own.tobytes())
                    full, rest = divmod(n, capacity)
                    for size, k in zip([capacity] * full + tails[rest], [1] * full + tail_classes[rest], strict=True):
                        of.append(i)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                        tokens.append(n)
                        kind.append(k)
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(of, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        pa.array(crc, pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(kind, pa.int32()),
                        rows.column(2).take(pa.array(of, pa.int64())),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "h1"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h1"))
    return small_batches(rows).mapInArrow(run, _PIECES.format(kind))


def _first_fit(capacity: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "place", "class"], ascending=[False, True, True], ignore_index=True)
        used, bins, offsets = [], [], []
        for n in rows["length"]:
            b = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
            if b == len(used):
                used.append(0)
            bins.append(b)
            offsets.append(used[b])
            used[b] += n
        return rows.assign(bin=bins, offset=offsets)

    return fit


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ``sequence_id`` and the ``offset`` in that sequence."""
    pieces = written(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = pieces.groupBy("class").agg(F.count("*").alias("n"))
    # At most one row for each class; full bins of smaller k come first.
    per_class = {r["class"]: r["n"] for r in counts.collect()}
    first, table = 0, []
    for k in sorted(per_class):
        table.append((k, first, per_class[k] // k * k))
        first += per_class[k] // k
    spark = docs.sparkSession
    bases = F.broadcast(spark.createDataFrame(table, "class int, first_bin long, in_full_bins long"))
    order = [F.col(c) for c in ("doc_id", "h1", "start")]
    numbered = placed(pieces, ["class"], F.lit(1), order, "place", sum(per_class.values())).join(bases, "class")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]

    full = numbered.where("place < in_full_bins").withColumn(
        "sequence_id", F.col("first_bin") + F.floor(F.col("place") / F.col("class"))
    )
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    last = numbered.where("place >= in_full_bins").drop("h1", "first_bin", "in_full_bins")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in last.schema)
    last = (
        last.withColumn("_all", F.lit(0))
        .groupBy("_all")
        .applyInPandas(_first_fit(capacity), f"{fields}, _all int, bin long, offset long")
        .withColumn("sequence_id", F.col("bin") + F.lit(first))
    )
    out = full.select(*columns).unionByName(last.select(*columns))
    return out.withColumn("length", F.col("length").cast("long"))
