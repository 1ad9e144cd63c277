"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: of every ``WINNOW`` consecutive ``SEED``-word grams, which
together span ``LENGTH`` = 35 words, the one of smallest hash. So every 35-word window has
one anchor, equal windows have equal anchors at equal places, and a passage that repeats
can only lie around anchors that repeat. Documents are joined on repeated anchors.

Each anchor occurrence is then extended both ways as far as its windows reach (its
extent, at most 58 words). Occurrences of one anchor with equal extents form a class; a
class of two or more repeats as a whole. Where an anchor has several classes, only a
representative of each is extended window by window, and windows are compared by the
words to the left and right of the anchor, through hashes, in one aggregation. Nothing is
expanded to pairs, so an anchor in a third of all documents costs its own occurrences.
Windows that repeat are laid over each other; their unions are the maximal repeats of at
least 35 words, which are removed.

Anchors, extents and windows are identified by 128 bits (two independent hashes).

Defined results: a null, empty or shorter text has no window and keeps its words; rows
that repeat a ``doc_id`` and text repeat each other as any two rows do; extra columns are
ignored; an empty table gives an empty result. A text's windows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.shared import small_batches, written
from clickflow.llm.words import SPAN_POWERS, Spans, as_long, text_blocks

#: Words of a window whose repetition removes it.
LENGTH = 35
#: Words of an anchor, and grams among which it is the smallest.
SEED = 12
WINNOW = LENGTH - SEED + 1
#: A run of windows is kept as (first window * RUN + number of windows).
RUN = 32


def _smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the first place of the minimum of values[i : i + width]."""
    best, place = values, np.arange(len(values))
    out_best = out_place = None
    done, step = 0, 1
    while True:
        if width & step:
            if out_place is None:
                out_best, out_place = best, place
            else:
                n = min(len(out_best), len(best) - done)
                right = best[done : done + n] < out_best[:n]
                out_place = np.where(right, place[done : done + n], out_place[:n])
                out_best = np.minimum(out_best[:n], best[done : done + n])
            done += step
        if done == width:
            return out_place
        n = len(best) - step
        if n <= 0:
            return np.empty(0, np.int64)
        right = best[step:] < best[:n]
        place = np.where(right, place[step:], place[:n])
        best = np.minimum(best[:n], best[step:])
        step *= 2


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text: ``tag`` tells rows of one doc_id with different texts apart."""
    return docs.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("tag"), "text")


def anchors(rows: DataFrame) -> DataFrame:
    """Every anchor occurrence: anchor, extent, doc_id, tag, run."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                windows = texts.window_starts(LENGTH)
                if not len(windows):
                    continue
                words = texts.word_hashes()
                seeds, extents = Spans(words, SPAN_POWERS[0]), Spans(texts.word_hashes(1), SPAN_POWERS[1])
                at = np.arange(len(words) - SEED + 1)
                grams = seeds(at, at + SEED)
                anchor = _smallest_in_window(grams, WINNOW)[windows]
                first = np.flatnonzero(np.diff(anchor, prepend=-1))
                count = np.diff(np.append(first, len(windows)))
                start = windows[first]
                of = np.searchsorted(texts.first, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(grams[anchor[first]]),
                        as_long(extents(start, start + count - 1 + LENGTH)),
                        part.column(0).take(pa.array(of)),
                        part.column(1).take(pa.array(of)),
                        pa.array((start - texts.first[of]) * RUN + count),
                    ],
                    ["anchor", "extent", "doc_id", "tag", "run"],
                )

    return small_batches(rows).mapInArrow(run, f"anchor long, extent long, doc_id {kind}, tag binary, run long")


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``left`` with ``right`` of the same document (null-safe)."""
    right = right.withColumnRenamed("doc_id", "_id").withColumnRenamed("tag", "_tag")
    same = left["doc_id"].eqNullSafe(right["_id"]) & left["tag"].eqNullSafe(right["_tag"])
    return left.join(right, same, how).drop("_id", "_tag")


def _windows(requests: DataFrame) -> DataFrame:
    """The windows of the requested runs: anchor, extent, offset, window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                lists = part.column(part.schema.get_field_index("runs"))
                flat = lists.flatten()
                of = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                anchor, extent, place = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                start, count = texts.first[of] + place // RUN, place % RUN
                which = np.repeat(np.arange(len(start)), count)
                offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                at = start[which] + offset
                extents = Spans(texts.word_hashes(1), SPAN_POWERS[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[which]),
                        pa.array(extent[which]),
                        pa.array(offset.astype(np.int32)),
                        as_long(extents(at, at + LENGTH)),
                    ],
                    ["anchor", "extent", "offset", "window"],
                )

    return requests.select("text", "runs").mapInArrow(run, "anchor long, extent long, offset int, window long")


def repeated_runs(rows: DataFrame) -> DataFrame:
    """Runs of windows that repeat, by document: doc_id, tag, runs (first window and a bit
    for each of its run's windows)."""
    # Sums over keys are written before they are joined back: a join that reads a shuffle on
    # either side can be split where a key is hot, one on top of an aggregate cannot.
    found = anchors(rows)
    again = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    seen = written(found.join(written(again, "anchors"), "anchor"), "occurrences")

    classes = written(
        seen.groupBy("anchor", "extent").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "tag", "run")).alias("one")
        ),
        "classes",
    )
    several = classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    several = written(several, "anchors")
    asked = (
        classes.join(several, "anchor")
        .groupBy("one.doc_id", "one.tag")
        .agg(F.collect_list(F.struct("anchor", "extent", F.col("one.run").alias("run"))).alias("runs"))
    )
    windows = written(_windows(_joined(rows, asked, "inner")), "windows")
    # A window in two classes of its anchor repeats; minimum and maximum tell two from one.
    shared = (
        windows.groupBy("anchor", "window")
        .agg(F.min("extent").alias("least"), F.max("extent").alias("most"))
        .where("least <> most")
        .select("anchor", "window")
    )
    shared = written(shared, "shared")
    bits = (
        windows.join(shared, ["anchor", "window"])
        .groupBy("anchor", "extent")
        .agg(F.bit_or(F.expr("shiftleft(1L, offset)")).alias("bits"))
    )
    repeats = classes.join(bits, ["anchor", "extent"], "left").select(
        "anchor", "extent", F.when(F.col("n") > 1, -1).otherwise(F.coalesce("bits", F.lit(0))).cast("long").alias("bits")
    )
    repeats = written(repeats.where("bits <> 0"), "repeats")
    return (
        seen.join(repeats, ["anchor", "extent"])
        .groupBy("doc_id", "tag")
        # Repeated rows bring each of their runs once.
        .agg(F.collect_set(F.struct("run", "bits")).alias("runs"))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_removed, kept_text (kept words joined by one space) and
    repeats, the word ranges (from, to) of the maximal repeats that were removed."""
    rows = _identified(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                lists = part.column(part.schema.get_field_index("runs"))
                lengths = np.diff(lists.offsets.to_numpy())
                lengths[np.asarray(lists.is_null())] = 0
                of = np.repeat(np.arange(len(part)), lengths)
                flat = lists.flatten()
                place, bits = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                gone = np.zeros(len(texts.starts) + 1, np.int64)
                for offset in range(WINNOW):
                    hit = (offset < place % RUN) & ((bits >> offset) & 1 == 1)
                    at = (texts.first[of] + place // RUN + offset)[hit]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + LENGTH, -1)
                gone = np.cumsum(gone[:-1]) > 0
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), texts.first[:-1])
                removed[texts.n_words == 0] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(texts.n_words),
                        pa.array(removed),
                        pa.array([_kept(texts, gone, i) for i in range(len(part))], pa.string()),
                        pa.array([_ranges(gone[a:b]) for a, b in zip(texts.first[:-1], texts.first[1:], strict=True)]),
                    ],
                    schema=pa.schema(
                        [
                            ("doc_id", part.column(0).type),
                            ("n_words", pa.int64()),
                            ("n_removed", pa.int64()),
                            ("kept_text", pa.string()),
                            ("repeats", pa.list_(pa.list_(pa.int64()))),
                        ]
                    ),
                )

    return (
        _joined(rows, repeated_runs(rows), "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(
            run, f"doc_id {kind}, n_words long, n_removed long, kept_text string, repeats array<array<long>>"
        )
    )


def _kept(texts, gone: np.ndarray, i: int) -> str:
    first, end = int(texts.first[i]), int(texts.first[i + 1])
    data, keep = texts.data, np.flatnonzero(~gone[first:end]) + first
    if not len(keep):
        return ""
    # Runs of kept words are taken whole; their separators become single spaces.
    raw = data[texts.starts[first] : texts.ends[end - 1]].tobytes()
    base = int(texts.starts[first])
    cuts = np.flatnonzero(np.diff(keep) != 1)
    lows, highs = np.append(keep[0], keep[cuts + 1]), np.append(keep[cuts], keep[-1])
    parts = (raw[int(texts.starts[a]) - base : int(texts.ends[b]) - base] for a, b in zip(lows, highs, strict=True))
    # bytes.split() cuts at exactly the separators: space and 0x09-0x0D.
    return b" ".join(w for p in parts for w in p.split()).decode()


def _ranges(gone: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()
