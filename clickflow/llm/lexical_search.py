"""Ranked lexical search over bit-sliced Bloom signatures.

``build_index`` writes, for blocks of documents, one Bloom signature per document, bit-sliced:
slice b is a bitmap over the block's documents whose bit b is set. A document enters each term
once for every power of two up to its frequency, so the bitmaps that a term and a power select
never miss a document with that many occurrences; they may hold others. Documents of a block
have signatures of one width, a power of two for their number of entries. Next to the
signatures the block stores its documents' ids and texts, so that whatever the signatures do not
rule out is rescored where it lies.

``search`` weighs the bitmaps: for each power, the sum of an item's term weights over the
documents that may reach it, times what that power can add to the score at the document's
length and greatest frequency. The total is never less than the score. Documents are rescored
exactly, from their texts, in the order of their totals, until the next total is below the
item's floor: the ``top``-th best exact score found so far. What is left out is proven to
rank lower, so results are exact, ties included. A first pass over one in ``FLOOR_BLOCKS`` of
the blocks sets the floors with which the pass over all blocks begins; it changes how much is
rescored, never the result. A task returns at most ``top`` rows for each item.

The statistics (documents, terms, document frequencies) are counted over all documents. Items are
searched in blocks of at most ``BLOCK_TERMS`` terms; only an item block's terms, weights and floors
go to the tasks. No document is shuffled.

Defined results: a null text has no terms; each row is a document, so repeated rows rank next to
each other; a null doc_id ranks after the others of its score; a null item has no rows;
items of equal item_id and text count once; texts of any length are read whole; empty tables give
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickflow.llm.shared import shared_folder, small_batches, written
from clickflow.llm.words import mix

TOP = 50
#: One in so many blocks sets the floors.
FLOOR_BLOCKS = 16
#: Terms of an item block, counted once for each item.
BLOCK_TERMS = 100_000
#: Frequencies are told apart by powers of two below this one.
LEVELS = 6
HASHES = 3
BITS_PER_ENTRY = 8
MOST_DOCS = 2048
#: Bits of a block of ordinary documents; one document's signature may be larger.
BLOCK_BITS = 1 << 24
#: Terms of an item whose bitmaps are held at once.
SLICE_TERMS = 2048

# Term characters are ASCII letters and digits and all of non-ASCII; only A-Z is folded.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split() if text else []


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def part(tf, m):
    """What ``tf`` occurrences add for a weight of one; rises with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


# ------------------------------------------------------------------------------- index
def _places(hashes: np.ndarray, levels: np.ndarray, width: int) -> np.ndarray:
    """The HASHES bits of (term, level) entries, one row each."""
    mixed = mix(hashes + (levels.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    at = mixed[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return (at & np.uint64(width - 1)).astype(np.int64)


def _hashed(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms))


class _Block:
    """Documents of one signature width, gathered until they fill a block."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.full = max(1, min(MOST_DOCS, BLOCK_BITS // width))
        self.ids: list = []
        self.texts: list[bytes] = []
        self.sizes: list[int] = []
        self.most: list[int] = []
        self.docs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, doc_id, text: bytes, tf: np.ndarray, hashes: np.ndarray, levels: np.ndarray) -> int:
        places = _places(hashes, levels, self.width).ravel()
        self.docs.append(np.full(len(places), len(self.ids), np.int32))
        self.places.append(places.astype(np.int32))
        self.ids.append(doc_id)
        self.texts.append(text)
        self.sizes.append(int(tf.sum()))
        self.most.append(int(tf.max()))
        return 8 * len(places) + len(text)

    def row(self) -> dict:
        n = len(self.ids)
        bits = np.zeros((self.width, -(-n // 8) * 8), bool)
        bits[np.concatenate(self.places), np.concatenate(self.docs)] = True
        return {
            "width": self.width, "n_docs": n, "n_terms": sum(self.sizes), "slices": np.packbits(bits, axis=1).tobytes(),
            "sizes": np.array(self.sizes, np.int64).tobytes(), "most": np.array(self.most, np.int64).tobytes(),
            "doc_ids": self.ids, "texts": self.texts,
        }


#: Bytes of gathered documents beyond which a task writes its fullest block.
HELD_BYTES = 96 << 20


def _index_schema(documents: DataFrame) -> tuple[pa.Schema, str]:
    kind = documents.schema["doc_id"].dataType
    arrow = pa.schema([
        ("width", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("slices", pa.binary()), ("sizes", pa.binary()),
        ("most", pa.binary()), ("doc_ids", pa.list_(to_arrow_type(kind))), ("texts", pa.list_(pa.binary())),
    ])
    return arrow, (
        "width long, n_docs long, n_terms long, slices binary, sizes binary, most binary, "
        f"doc_ids array<{kind.simpleString()}>, texts array<binary>"
    )


def _index_task(schema: pa.Schema):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        held: dict[int, int] = {}

        def out(width: int) -> pa.RecordBatch:
            del held[width]
            return pa.RecordBatch.from_pylist([blocks.pop(width).row()], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                counts = Counter(terms_of(text))
                if not counts:
                    continue
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                levels = np.minimum(np.log2(tf).astype(np.int64), LEVELS - 1)
                # One entry for each power of two up to the frequency.
                entry = np.repeat(np.arange(len(tf)), levels + 1)
                level = np.arange(len(entry)) - np.repeat(np.cumsum(levels + 1) - levels - 1, levels + 1)
                width = 64
                while width < BITS_PER_ENTRY * len(entry):
                    width *= 2
                block = blocks.setdefault(width, _Block(width))
                held[width] = held.get(width, 0) + block.add(doc_id, text, tf, _hashed(list(counts))[entry], level)
                if len(block.ids) == block.full:
                    yield out(width)
                while sum(held.values()) > HELD_BYTES:
                    yield out(max(held, key=held.get))
        while blocks:
            yield out(next(iter(blocks)))

    return task


def build_index(documents: DataFrame, path: str) -> DataFrame:
    """Write the signature blocks of (doc_id, text) to the new folder ``path`` and read them back."""
    arrow, columns = _index_schema(documents)
    rows = documents.where("text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text"))
    small_batches(rows).mapInArrow(_index_task(arrow), columns).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(columns).parquet(path)


# ------------------------------------------------------------------------------ search
@dataclass
class Items:
    """A block of items: their terms (as places in ``terms``) with weights, and their floors."""

    terms: list[bytes]
    uses: list[np.ndarray]
    weights: list[np.ndarray]
    documents: int
    words: int

    def share(self, sizes: np.ndarray) -> np.ndarray:
        """The m of documents of ``sizes`` terms."""
        return 50 + (50 * sizes * self.documents) // self.words


def _upper_bounds(items: Items, block: dict, hashes: np.ndarray, cache: dict) -> Iterator[tuple[int, np.ndarray]]:
    """For each item, what the block's documents can score at most."""
    n, width = block["n_docs"], block["width"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    sizes, most = np.frombuffer(block["sizes"], np.int64), np.frombuffer(block["most"], np.int64)
    share = items.share(sizes)
    reach = [np.minimum(2 ** (k + 1) - 1, most) if k < LEVELS - 1 else most for k in range(LEVELS)]
    most_parts = np.stack([np.zeros(n, np.int64), *[part(r, share) for r in reach]])
    gains = np.diff(most_parts, axis=0)
    if width not in cache:
        cache[width] = [_places(hashes, np.full(len(hashes), k), width) for k in range(LEVELS)]
    for item, (uses, weights) in enumerate(zip(items.uses, items.weights)):
        total = np.zeros(n, np.int64)
        for at in range(0, len(uses), SLICE_TERMS):
            some, w = uses[at : at + SLICE_TERMS], weights[at : at + SLICE_TERMS].astype(np.float64)
            held = None
            for k in range(LEVELS):
                maybe = np.bitwise_and.reduce(slices[cache[width][k][some]], axis=1)
                held = maybe if held is None else held & maybe
                if not held.any():
                    break
                # Sums of weights stay far below 2**53, so they are exact.
                total += (w @ np.unpackbits(held, axis=1, count=n)).astype(np.int64) * gains[k]
        yield item, total


def _df_task(terms: list[bytes]):
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}
        counts = np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for text in batch.column("texts")[i].as_py():
                    for t in place.keys() & set(terms_of(text)):
                        counts[place[t]] += 1
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], schema=schema)

    return task


def _best_task(items: Items, floors: np.ndarray, top: int, id_type: pa.DataType):
    """Each item's ``top`` best documents of the task's blocks, none below its floor."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", id_type), ("score", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, cache = _hashed(items.terms), {}
        place = {t: i for i, t in enumerate(items.terms)}
        weights = [dict(zip(u.tolist(), w.tolist())) for u, w in zip(items.uses, items.weights)]
        low = floors.tolist()
        best: list[list[tuple]] = [[] for _ in low]

        def lowest_out(item: int) -> None:
            best[item].sort()
            del best[item][top:]
            if len(best[item]) == top:
                low[item] = max(low[item], -best[item][-1][0])

        for batch in batches:
            for i in range(batch.num_rows):
                block = {n: batch.column(n)[i].as_py() for n in ("width", "n_docs", "slices", "sizes", "most", "doc_ids")}
                texts, parts = batch.column("texts")[i].values, {}

                def parts_of(j: int) -> dict[int, int]:
                    if j not in parts:
                        counts = Counter(terms_of(texts[j].as_py()))
                        m = 50 + (50 * counts.total() * items.documents) // items.words
                        parts[j] = {place[t]: part(counts[t], m) for t in counts.keys() & place.keys()}
                    return parts[j]

                for item, total in _upper_bounds(items, block, hashes, cache):
                    found = np.flatnonzero(total >= low[item])
                    found = found[np.argsort(-total[found], kind="stable")]
                    for j, most in zip(found.tolist(), total[found].tolist()):
                        if most < low[item]:
                            break
                        had, w = parts_of(j), weights[item]
                        score = sum(w[t] * had[t] for t in w.keys() & had.keys())
                        if score >= low[item]:
                            doc_id = block["doc_ids"][j]
                            best[item].append((-score, doc_id is None, 0 if doc_id is None else doc_id))
                            if len(best[item]) >= 2 * top:
                                lowest_out(item)
                    lowest_out(item)
        for item, entries in enumerate(best):
            rows = [{"item": item, "doc_id": None if null else d, "score": -s} for s, null, d in entries]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return task


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(item_id, distinct terms) of the items, in blocks of at most BLOCK_TERMS terms or one item."""
    block: list[tuple[int, list[bytes]]] = []
    held = 0
    distinct = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    for row in distinct.orderBy("item_id", "text").toLocalIterator():
        terms = list(dict.fromkeys(terms_of(row["text"])))
        if not terms:
            continue
        if block and held + len(terms) > BLOCK_TERMS:
            yield block
            block, held = [], 0
        block.append((row["item_id"], terms))
        held += len(terms)
    if block:
        yield block


def search(index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of ``index`` by score, then
    doc_id."""
    spark = index.sparkSession
    id_type, doc_type = items.schema["item_id"].dataType, index.schema["doc_ids"].dataType.elementType
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("words")).first()
    found = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id {doc_type.simpleString()}, score long")
    for block in _item_blocks(items) if totals["n"] else ():
        found = found.unionByName(_search_block(index, block, top, totals["n"], totals["words"], id_type))
    return found


def _search_block(index, block, top, n_docs, n_words, id_type) -> DataFrame:
    spark = index.sparkSession
    terms = sorted({t for _, ts in block for t in ts})
    counted = index.select("texts").mapInArrow(_df_task(terms), "term int, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).collect()
    weight = {terms[r["term"]]: term_weight(n_docs, r["n"]) for r in counted}
    terms = [t for t in terms if weight.get(t, 0) > 0]
    place = {t: i for i, t in enumerate(terms)}
    used = [sorted(place[t] for t in ts if t in place) for _, ts in block]
    item_block = Items(
        terms, [np.array(u, np.int64) for u in used], [np.array([weight[terms[i]] for i in u], np.int64) for u in used],
        n_docs, n_words,
    )
    doc_type = index.schema["doc_ids"].dataType.elementType

    def best(blocks: DataFrame, floors: np.ndarray, order: list) -> DataFrame:
        task = _best_task(item_block, floors, top, to_arrow_type(doc_type))
        rows = blocks.drop("n_terms").mapInArrow(task, f"item int, doc_id {doc_type.simpleString()}, score long")
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)

    floors = np.ones(len(block), np.int64)
    some = index.where(F.pmod(F.xxhash64("slices"), F.lit(FLOOR_BLOCKS)) == 0)
    for row in best(some, floors, [F.desc("score")]).where(F.col("rank") == top).collect():
        floors[row["item"]] = row["score"]
    found = best(index, floors, [F.desc("score"), F.asc_nulls_last("doc_id")])
    names = spark.createDataFrame(
        [(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {id_type.simpleString()}"
    )
    return written(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-found")


def rank_documents(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``search`` with an index built for it."""
    return search(build_index(documents, shared_folder(documents.sparkSession, "search-index")), items, top)
