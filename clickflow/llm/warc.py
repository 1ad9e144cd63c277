"""Deterministic sharded WARC archives.

``write_archives`` writes one record for each page. Records are sorted by their URL in
host-first order and cut into shards of about equal bytes; the cuts are quantiles of the
records of small hashes, so they depend on the records alone and reruns write the same
bytes. Tasks regenerate headers and digests, compress each record as a gzip member of its own,
and shuffle the compressed members; one task writes a shard and rolls to a new file where the
next member would take a file past ``file_bytes``.

A task writes to temporary names that no other attempt shares and reports them as rows; Spark
keeps the rows of one attempt. Only those files get their final names, in a second job whose
every step may be repeated, and the manifest of final names is the commit: readers open what
it lists and nothing else. Lost executors, retries and speculation leave at most temporary
files, which the commit removes.

Of records with equal payloads of at least ``min_bytes`` bytes the first one (smallest page_id,
then URL, nulls last) is the response and carries the payload; the others are revisits and
carry headers only. Copies collapse by partial aggregation and their payloads are dropped
before the shuffle, so a payload that a third of all pages share costs its headers.

Defined results: a null html is an empty payload; a null page_id or url is left out of the
record's headers and read back as null; control characters in URLs are percent-encoded;
repeated rows give one record each, in a fixed order; long payloads are handled whole, one
record at a time; an empty table gives an empty manifest; extra columns are ignored. Files go
through ``pyarrow.fs``, so the folder may be any store that it and Spark both reach.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import small_batches, written

#: Bytes of payload in a shard, until there are MOST_SHARDS; from there on shards grow.
SHARD_BYTES = 64 << 20
MOST_SHARDS = 8192
SAMPLE_PER_SHARD = 16
#: Compressed bytes after which a shard goes on in a new file.
FILE_BYTES = 256 << 20
#: Pages have no date of their own, and reruns agree.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6

# The digits of base 32 in Spark's conv() and in RFC 4648, and WARC's names.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"

#: What orders the records: host-first URL (a bounded part of it), page, payload, copy.
ORDER = ["site", "no_page", "page_id", "digest", "copy"]
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column: 40 bits at a time."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def _site(url: Column) -> Column:
    """The URL with its host's labels reversed, cut to 200 characters: a sort key."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.substring(F.concat(F.concat_ws(",", F.reverse(F.split(host, "[.]"))), F.lit(")"), path), 1, 200)


def _pages(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        base32_sha1(payload).alias("digest"), F.length(payload).cast("long").alias("n_bytes"),
    )


def _ordered(df: DataFrame) -> DataFrame:
    return df.withColumns({"site": _site(F.coalesce("url", F.lit(""))), "no_page": F.col("page_id").isNull()})


def _first() -> Column:
    return F.struct(F.col("page_id").isNull().alias("no_page"), "page_id", F.col("url").isNull().alias("no_url"), "url")


def _records(pages: DataFrame, shared: DataFrame | None) -> DataFrame:
    """One row for each record: ORDER's columns, url, n_bytes, ``first`` (the response's page and
    URL, null for a payload of one page) and the payload, null in revisits."""
    if shared is None:
        return pages.withColumns({"copy": F.lit(0).cast("long"), "first": F.lit(None).cast("struct<page_id: long, url: string>")})
    joined = pages.join(shared, ["digest", "n_bytes"], "left")
    alone = joined.where("first IS NULL").withColumn("copy", F.lit(0).cast("long"))
    is_first = _first().eqNullSafe(F.col("first"))
    copies = joined.where("first IS NOT NULL").groupBy("digest", "n_bytes", "page_id", "url", "first")
    copies = copies.agg(
        F.first(F.when(is_first, F.col("payload")), ignorenulls=True).alias("payload"), F.count(F.lit(1)).alias("_n")
    )
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
    copies = copies.withColumn("payload", F.when(F.col("copy") == 0, F.col("payload")))
    brief = F.when(F.col("first").isNotNull(), F.struct("first.page_id", "first.url")).alias("first")
    return alone.unionByName(copies).withColumn("first", brief)


def _bounds(meta: DataFrame, shard_bytes: int) -> list[tuple]:
    """The ORDER keys at which shards begin, but for the first."""
    whole = meta.agg(F.sum(F.col("n_bytes") + 512).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(1, min(MOST_SHARDS, math.ceil((whole["bytes"] or 0) / shard_bytes)))
    if shards == 1:
        return []
    slim = meta.groupBy("page_id", "url", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("_n"))
    slim = slim.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    slim = _ordered(slim).select(*ORDER, F.when(F.col("copy") == 0, F.col("n_bytes")).otherwise(0).alias("weight"))
    # About SAMPLE_PER_SHARD records for each shard, told by their hashes.
    share = math.ceil(min(1.0, shards * SAMPLE_PER_SHARD / whole["rows"]) * 2**62)
    sample = slim.where(F.xxhash64("site", "page_id", "digest", "copy").bitwiseAND(F.lit(2**62 - 1)) < share)
    rows = sorted((_key(r.asDict()), r["weight"] + 512) for r in sample.collect())
    sampled, run, bounds = sum(w for _, w in rows), 0, []
    for key, weight in rows:
        if run >= sampled * (len(bounds) + 1) / shards:
            bounds.append(key)
        run += weight
    return bounds


def _key(row: dict) -> tuple:
    return (row["site"], row["no_page"], row["page_id"] or 0, row["digest"], row["copy"])


# ------------------------------------------------------------------------------ records
def _headers(pairs: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in pairs if v is not None)


def _safe(url: str | None) -> str | None:
    return None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(page_id: int | None, url: str | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {copy} {url}')}>"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(kind: str, pairs: list[tuple[str, str | None]], block: bytes, level: int) -> bytes:
    """One record as a gzip member (which holds no time or name, so equal records are equal)."""
    head = VERSION + b"\r\n" + _headers([("WARC-Type", kind), *pairs, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n") + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_member(row: dict, date: str = DATE, level: int = LEVEL) -> bytes:
    """The record of a page: a response with its payload, or a revisit without."""
    payload, first = row["payload"], row["first"]
    http = b"HTTP/1.1 200 OK\r\n" + _headers(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["n_bytes"]))]
    )
    block = http + b"\r\n" + (payload or b"")
    pairs = [
        ("WARC-Record-ID", _record_id(row["page_id"], row["url"], row["digest"], row["copy"])),
        ("WARC-Date", date), ("WARC-Target-URI", _safe(row["url"])),
        ("Page-ID", None if row["page_id"] is None else str(row["page_id"])),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{_digest(block)}"), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
    ]
    if payload is not None:
        return _member("response", pairs, block, level)
    pairs += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", _record_id(first["page_id"], first["url"], row["digest"], 0)),
        ("WARC-Refers-To-Target-URI", _safe(first["url"])), ("WARC-Refers-To-Date", date),
        ("Refers-To-Page-ID", None if first["page_id"] is None else str(first["page_id"])),
    ]
    return _member("revisit", pairs, block, level)


def _info_member(name: str, date: str, level: int) -> bytes:
    block = _headers([("software", "clickflow"), ("format", "WARC File Format 1.1")])
    pairs = [
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
    ]
    return _member("warcinfo", pairs, block, level)


# ------------------------------------------------------------------------------ writing
_SORTED = [("site", pa.string()), ("no_page", pa.bool_()), ("page_id", pa.int64()), ("digest", pa.string()), ("copy", pa.int64())]
_MANIFEST = pa.schema([
    ("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int32()), ("roll", pa.int32()),
    ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string()),
])
_MANIFEST_SQL = "name string, temporary string, shard int, roll int, n_records long, n_bytes long, sha256 string"


def _members(bounds: list[tuple], date: str, level: int):
    schema = pa.schema([("shard", pa.int32()), *_SORTED, ("member", pa.binary())])
    names = [n for n, _ in _SORTED]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                member = page_member(row, date, level)
                out.append({"shard": bisect.bisect_right(bounds, _key(row)), **{n: row[n] for n in names}, "member": member})
                held += len(member)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    return task


class _File:
    """A file under a temporary name, and its row of the manifest."""

    def __init__(self, folder: str, shard: int, roll: int, info) -> None:
        store, place = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(f"{place}/_temporary", recursive=True)
        self.row = {
            "name": f"shard-{shard:05d}-{roll:05d}.warc.gz", "shard": shard, "roll": roll,
            "temporary": f"_temporary/shard-{shard:05d}-{roll:05d}-{uuid.uuid4().hex}", "n_records": 0, "n_bytes": 0,
        }
        self.out = store.open_output_stream(f"{place}/{self.row['temporary']}", compression=None)
        self.digest = hashlib.sha256()
        self._put(info(self.row["name"]))

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.row["n_bytes"] += len(member)

    def add(self, member: bytes) -> None:
        self._put(member)
        self.row["n_records"] += 1

    def close(self) -> dict:
        self.out.close()
        return {**self.row, "sha256": self.digest.hexdigest()}


def _write(folder: str, file_bytes: int, date: str, level: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = lambda name: _info_member(name, date, level)
        current: _File | None = None
        done: list[dict] = []
        for batch in batches:
            for shard, member in zip(batch.column("shard"), batch.column("member")):
                shard, member = shard.as_py(), member.as_py()
                if current is not None:
                    row = current.row
                    full = row["n_records"] > 0 and row["n_bytes"] + len(member) > file_bytes
                    if row["shard"] != shard or full:
                        done.append(current.close())
                        current = _File(folder, shard, row["roll"] + 1 if row["shard"] == shard else 0, info)
                else:
                    current = _File(folder, shard, 0, info)
                current.add(member)
        if current is not None:
            done.append(current.close())
        yield pa.RecordBatch.from_pylist(done, _MANIFEST)

    return task


def _rename(folder: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held, final = f"{place}/{row['temporary']}", f"{place}/{row['name']}"
                # A repeated attempt finds the work done.
                if store.get_file_info(held).type != pyarrow.fs.FileType.NotFound:
                    store.move(held, final)
                if store.get_file_info(final).size != row["n_bytes"]:
                    raise OSError(f"{row['name']} is not the file that was written")
            yield batch

    return task


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
    level: int = LEVEL,
) -> DataFrame:
    """Write (page_id, url, html) of ``pages`` as WARC files below the new ``folder``; returns the
    manifest, one row for each file."""
    spark = pages.sparkSession
    pages = _pages(pages)
    meta = written(pages.drop("payload"), "warc-meta")
    same = meta.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
    same = same.agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    shared = written(same, "warc-shared")
    bounds = _bounds(meta, shard_bytes)
    records = small_batches(_ordered(_records(pages, None if shared.isEmpty() else shared)))
    members = records.mapInArrow(
        _members(bounds, date, level),
        "shard int, site string, no_page boolean, page_id long, digest string, copy long, member binary",
    )
    placed = members.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", *ORDER)
    staged = f"{folder}/_staged"
    placed.select("shard", "member").mapInArrow(_write(folder, file_bytes, date, level), _MANIFEST_SQL).write.parquet(staged)
    files = spark.read.schema(_MANIFEST_SQL).parquet(staged)
    spread = files.repartitionByRange(max(1, min(256, len(bounds) + 1)), "name")
    spread.mapInArrow(_rename(folder), _MANIFEST_SQL).drop("temporary").write.parquet(f"{folder}/manifest")
    store, place = pyarrow.fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{place}/_temporary").type != pyarrow.fs.FileType.NotFound:
        store.delete_dir(f"{place}/_temporary")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_SQL.replace("temporary string, ", "")).parquet(f"{folder}/manifest")


# ------------------------------------------------------------------------------ reading
def members_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked one at a time."""
    unpacker, parts, fed = zlib.decompressobj(31), [], False
    for chunk in chunks:
        while chunk:
            parts.append(unpacker.decompress(chunk))
            fed, chunk = True, b""
            if unpacker.eof:
                yield b"".join(parts)
                chunk, unpacker, parts, fed = unpacker.unused_data, zlib.decompressobj(31), [], False
    if fed:
        raise ValueError("the file ends inside a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and block of a record, whose length and digest must be right."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    headers = dict(line.decode().split(": ", 1) for line in lines[1:])
    block, end = rest[: int(headers["Content-Length"])], rest[int(headers["Content-Length"]) :]
    if lines[0] != VERSION or end != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    return headers, block


def page_of(headers: dict[str, str], block: bytes) -> dict:
    """What a response or revisit record says of its page; a response's payload is checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.decode().split(": ", 1) for line in http.split(b"\r\n")[1:])
    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Content-Length"])
    response = headers["WARC-Type"] == "response"
    if response and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("Page-ID"), "url": headers.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": headers["WARC-Type"], "refers_to": number("Refers-To-Page-ID"), "html": payload if response else None,
    }


def _read(folder: str, payloads: bool):
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.binary()),
    ])

    def chunks(stream) -> Iterator[bytes]:
        with stream:
            while data := stream.read(1 << 20):
                yield data

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = pyarrow.fs.FileSystem.from_uri(folder)
        out: list[dict] = []
        held = 0
        for batch in batches:
            for file in batch.to_pylist():
                stream = store.open_input_stream(f"{place}/{file['name']}", compression=None)
                seen = 0
                for record in members_of(chunks(stream)):
                    headers, block = parse_record(record)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    seen += 1
                    row = page_of(headers, block)
                    if not payloads:
                        row["html"] = None
                    out.append(row)
                    held += len(row["html"] or b"") + 256
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                if seen != file["n_records"]:
                    raise ValueError(f"{file['name']} holds {seen} of {file['n_records']} records")
        yield pa.RecordBatch.from_pylist(out, schema)

    return task


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the files that the manifest lists: (page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, html). Lengths and digests are checked. A revisit has
    no html of its own, and without ``payloads`` none has."""
    files = manifest(spark, folder)
    spread = files.repartitionByRange(max(1, files.count()), "name")
    return spread.mapInArrow(
        _read(folder, payloads),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html binary",
    )
