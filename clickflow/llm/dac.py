"""Token ids as directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds every id's
first chunk and a bitmap that tells which ids go on; level k holds the next chunks of those
that do, in order. A rank directory (ones before every ``RANK_BITS`` bits) finds an id's
place on the next level, so any id is read from a handful of bytes, without decoding a
block.

A segment is one byte string: magic, number of ids, number of levels, then for each level
its length, the chunks, the bitmap and the rank directory. Tasks write the corpus as files of
segments in ``doc_id`` order below ``ids``, as they are, so that ``token_at`` reads any id of
the corpus from some hundred bytes of a file. Their catalog is a table written by Spark: part,
segment, into (ids of the part before the segment), doc_ids, counts (the documents' id
counts, as such codes too), n_tokens, file, at, bytes. A part is what one write task holds;
parts follow each other in ``doc_id`` order. Every attempt of a task writes a file of its own
name, and Spark keeps the rows of one attempt: the catalog is the commit, and files that it
does not name are leavings of lost attempts. Files go through ``pyarrow.fs``, so the folder may
be any store that it and Spark both reach.

Defined results: a null text is empty and has its end id only; a null ``doc_id`` comes
first; rows of one ``doc_id`` are ordered by a hash of the text; repeated rows are documents of
their own; a very long text is a segment of its own; extra columns are ignored; an empty table
has no segments.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import small_batches
from clickflow.llm.token_ids import encoder
from clickflow.llm.words import text_blocks

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BITS = 512
END_ID = 2
#: Ids after which a segment ends at the next document.
SEGMENT_TOKENS = 1 << 20


def pack_ids(ids: np.ndarray) -> bytes:
    """``ids`` (unsigned, up to 32 bits) as one segment."""
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        levels.append(((rest & 0xFF).astype(np.uint8), goes_on))
        rest = more[goes_on]
        if not len(rest):
            break
    out = [MAGIC, struct.pack("<QB", len(ids), len(levels))]
    for chunks, goes_on in levels:
        bits = np.packbits(goes_on, bitorder="little")
        before = np.zeros(-(-len(chunks) // RANK_BITS), np.uint64)
        sums = np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(chunks), RANK_BITS)) if len(chunks) else [])
        before[1:] = sums[:-1]
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bits.tobytes(), before.astype("<u8").tobytes()]
    return b"".join(out)


class Segment:
    """Reads a segment: ``segment[i]`` for one id, ``all()`` for all of them. ``data`` is its
    bytes, or a function of offset and length that reads some of them: one id takes the
    header, and of each level its length, one chunk, a rank and at most ``RANK_BITS`` bits."""

    def __init__(self, data: bytes | Callable[[int, int], bytes]) -> None:
        self._read = data if callable(data) else lambda at, n: data[at : at + n]
        head = self._read(0, 13)
        if head[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.n, self.n_levels = struct.unpack_from("<QB", head, 4)

    def __len__(self) -> int:
        return self.n

    def _levels(self) -> Iterator[tuple[int, int, int, int]]:
        """Length of each level, and where its chunks, bitmap and ranks begin."""
        at = 13
        for _ in range(self.n_levels):
            (n,) = struct.unpack("<Q", self._read(at, 8))
            bitmap = at + 8 + n
            ranks = bitmap + -(-n // 8)
            yield n, at + 8, bitmap, ranks
            at = ranks + 8 * -(-n // RANK_BITS)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for _, chunks, bitmap, ranks in self._levels():
            value |= self._read(chunks + i, 1)[0] << shift
            block = i // RANK_BITS
            low = block * RANK_BITS
            # The bits of the block up to and with the id's own, lowest first.
            bits = int.from_bytes(self._read(bitmap + (low >> 3), (i - low >> 3) + 1), "little") & ((2 << (i - low)) - 1)
            if not bits >> (i - low):
                break
            i = struct.unpack("<Q", self._read(ranks + 8 * block, 8))[0] + bits.bit_count() - 1
            shift += CHUNK_BITS
        return value

    def all(self) -> np.ndarray:
        out = np.zeros(self.n, np.uint32)
        place = np.arange(self.n)
        for k, (n, chunks, bitmap, ranks) in enumerate(self._levels()):
            out[place] |= np.frombuffer(self._read(chunks, n), np.uint8).astype(np.uint32) << (CHUNK_BITS * k)
            bits = np.frombuffer(self._read(bitmap, ranks - bitmap), np.uint8)
            place = place[np.unpackbits(bits, count=n, bitorder="little").astype(bool)]
        return out


_FIELDS = "part int, segment int, into long, doc_ids array<{}>, counts binary, n_tokens long, file string, at long, bytes long"


def write_segments(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes every text and writes the corpus at ``path`` in ascending ``doc_id`` order."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        doc_ids, ids, counts, held, segment, into = [], [], [], 0, 0, 0
        # No other attempt has this name; the catalog names the files of those that count.
        name, out, at = f"ids/part-{part:05d}-{uuid.uuid4().hex}.dac", None, 0

        def flush() -> pa.RecordBatch:
            nonlocal out, at
            if out is None:
                store, place = pyarrow.fs.FileSystem.from_uri(path)
                store.create_dir(f"{place}/ids", recursive=True)
                out = store.open_output_stream(f"{place}/{name}", compression=None)
            names = pa.concat_arrays(doc_ids)
            data = pack_ids(np.concatenate(ids))
            out.write(data)
            at += len(data)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([into], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                    pa.array([pack_ids(np.concatenate(counts))], pa.binary()),
                    pa.array([held], pa.int64()),
                    pa.array([name]),
                    pa.array([at - len(data)], pa.int64()),
                    pa.array([len(data)], pa.int64()),
                ],
                ["part", "segment", "into", "doc_ids", "counts", "n_tokens", "file", "at", "bytes"],
            )

        for batch in batches:
            for rows, texts in text_blocks(batch):
                found, begins = encode(texts)
                # Every document's end id goes in after its ids.
                ids.append(np.insert(found, begins[1:], np.uint32(end_id)))
                counts.append((np.diff(begins) + 1).astype(np.uint32))
                doc_ids.append(rows.column(0))
                held += len(ids[-1])
                if held >= SEGMENT_TOKENS:
                    yield flush()
                    doc_ids, ids, counts, held, segment, into = [], [], [], 0, segment + 1, into + held
        last = flush() if held else None
        if out is not None:
            # Before the last row leaves: a task whose rows are kept has a whole file.
            out.close()
        if last is not None:
            yield last

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.hash("text"))
    small_batches(ordered).mapInArrow(run, _FIELDS.format(kind)).write.parquet(f"{path}/catalog")


def _catalog(spark: SparkSession, path: str) -> DataFrame:
    """The written segments with ``start``, the ids of the corpus before them."""
    segments = spark.read.parquet(f"{path}/catalog")
    # One row per write task, as many as the writer had shuffle partitions: one task orders
    # them, and they are small enough to send to every task.
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return segments.join(F.broadcast(parts), "part").withColumn("start", F.col("first") + F.col("into"))


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of the whole corpus. Of the file that holds it some hundred bytes
    are read, however long it is; the catalog is asked for that segment's row."""
    here = (F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position)
    row = _catalog(spark, path).where(here).select("file", "at", "start").first()
    if position < 0 or row is None:
        raise IndexError(position)
    store, place = pyarrow.fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{place}/{row['file']}") as file:
        return Segment(lambda at, n: file.read_at(n, row["at"] + at))[position - row["start"]]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written corpus: doc_id, start (ids before it), n_tokens, ids_crc32."""
    segments = _catalog(spark, path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in range(len(batch)):
                doc_ids = batch.column(0).slice(row, 1).flatten()
                counts = Segment(batch.column(1)[row].as_py()).all().astype(np.int64)
                name, at, size, start = (batch.column(c)[row].as_py() for c in range(2, 6))
                with store.open_input_file(f"{place}/{name}") as file:
                    data = file.read_at(size, at)
                if len(data) != size:
                    raise OSError(f"{name} is not the file that was written")
                ids = memoryview(Segment(data).all().astype("<u4").tobytes())
                ends = np.cumsum(counts)
                sums = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(start + ends - counts), pa.array(counts), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.select("doc_ids", "counts", "file", "at", "bytes", "start").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    )
