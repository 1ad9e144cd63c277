"""WARC archives: an exact round trip, the same bytes on every run, and damaged files."""

import base64
import gzip
import hashlib
import os
import random

import pytest

from clickflow.llm import warc
from clickflow.llm.shared import shared_folder
from tests.llm.cases import SF

SCHEMA = "page_id long, url string, html string, digest string, copy long, first string, shard int, n_bytes long"


def _odd_pages():
    rng = random.Random(6)
    hot = "<p>" + "same " * 50
    rows = [(i, f"http://site{i % 7}.example.com/{i}?q=é", f"<html>{rng.random()}") for i in range(120)]
    rows += [(200 + i, f"https://user@hot.example/{i}", hot) for i in range(300)]
    rows += [(7, "http://again.example/", "twice")] * 40 + [(6, "http://again.example/b", "twice"), (6, None, "twice")]
    rows += [(None, None, None), (None, None, None), (None, "http://x.example/", "no page"), (700, "", "")]
    rows += [(701, "http://bad.example/a\r\nX-Injected: 1\n", "long " + "ß" * 400_000), (702, "not a url", "\0\r\n\r\nWARC/1.1")]
    return rows


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA).repartition(5)


def _expected(rows, min_bytes=0):
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    groups = {}
    for r in rows:
        groups.setdefault(r[2] or "", []).append(r)
    out = []
    for html, group in groups.items():
        data = html.encode()
        group.sort(key=order)
        for k, r in enumerate(group):
            copy = k > 0 and len(data) >= min_bytes
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            out.append((r[0], len(data), digest, "revisit" if copy else "response", group[0][0] if copy else None))
    return sorted(out, key=repr)


def _told(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 100])
def test_round_trip_of_odd_pages(spark, min_bytes):
    rows, folder = _odd_pages(), shared_folder(spark, "warc")
    files = warc.write_archives(_pages(spark, rows), folder, min_bytes=min_bytes, shard_bytes=20_000, file_bytes=4_000)
    found = warc.read_archives(spark, folder)
    assert _told(found) == _expected(rows, min_bytes)
    listed = files.collect()
    assert len({f.shard for f in listed}) > 3 and any(f.roll for f in listed)
    assert all(f.n_bytes <= 4_000 or f.n_records == 1 for f in listed)
    got = {(r.page_id, r.url): bytes(r.html).decode() for r in found.where("record_type = 'response'").collect()}
    assert got[701, "http://bad.example/a%0D%0AX-Injected: 1%0A"] == rows[-2][2] and got[702, "not a url"] == rows[-1][2]


def test_same_files_on_every_run(spark):
    rows = _odd_pages()
    runs = []
    for n in (1, 4):
        folder = shared_folder(spark, "warc")
        files = warc.write_archives(_pages(spark, rows).repartition(n), folder, shard_bytes=20_000, file_bytes=4_000)
        runs.append(sorted((f.name, f.n_records, f.n_bytes, f.sha256) for f in files.collect()))
    assert runs[0] == runs[1]


def test_files_are_plain_warc(spark):
    folder = shared_folder(spark, "warc")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    files = warc.write_archives(pages, folder).collect()
    place = folder.removeprefix("file://").removeprefix("file:")
    held = sorted(n for n in os.listdir(place) if n.endswith(".gz"))
    assert held == sorted(f.name for f in files) and not os.path.exists(f"{place}/_temporary")
    whole = b"".join(gzip.decompress(open(f"{place}/{n}", "rb").read()) for n in held)
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    got = {r.page_id: (r.url, bytes(r.html).decode()) for r in warc.read_archives(spark, folder).collect()}
    assert got == {r.page_id: (r.url, r.html) for r in pages.collect()}
    # Files that the manifest does not list are not read.
    open(f"{place}/shard-99999-00000.warc.gz", "wb").write(b"left by nobody")
    assert warc.read_archives(spark, folder).count() == len(got)


def test_damage_is_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"body", "digest": warc._digest(b"body"), "n_bytes": 4, "copy": 0, "first": None}
    member = warc.page_member(row)
    record = next(warc.members_of(iter([member[:9], member[9:]])))
    assert warc.page_of(*warc.parse_record(record))["html"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"body", b"bodz"))
    with pytest.raises(ValueError):
        list(warc.members_of(iter([member[:-3]])))


def test_empty_table(spark):
    folder = shared_folder(spark, "warc")
    assert warc.write_archives(spark.createDataFrame([], SCHEMA), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0
