"""Mixing, sharding, packing, token output: laws, round trips and brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickflow.llm import dac, hilbert, mixing, packing
from clickflow.llm.words import text_blocks
from tests.llm.cases import both, crc_words, empty, words


def _ids(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_targets_fill_and_stop():
    sizes = [100, 1000, 50, 0, 3000]
    got = mixing.targets(sizes)
    assert got[0] == 300 and got[3] == 0 and abs(sum(got) - sum(sizes)) < 1e-6
    assert all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))
    # What is not stopped keeps the proportions of its weights 2, 1 and 2.
    assert got[1] / got[4] == pytest.approx(1) or got[2] == 150
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_one_to_one(n):
    assert sorted(mixing.permuted(np.arange(n), n, 7).tolist()) == list(range(n))


def test_drawn_counts_add_up():
    counts = mixing.draw_counts([1000, 0, 37, 500], 16, 3)
    assert counts.sum(axis=0).tolist() == [1000, 0, 37, 500]
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1


def test_mix_takes_targets(spark):
    docs = both(spark)
    rows = mixing.taken_words(docs).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, len(words(r.text))) for r in docs.collect())
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    source = defaultdict(set)
    for r in docs.select("doc_id", "source").collect():
        source[r.doc_id].add(r.source)
    taken, size = defaultdict(int), {}
    for r in rows:
        if len(source[r.doc_id]) == 1:
            taken[r.target, r.source_size] += r.taken
            size[r.target, r.source_size] = r.target
    names = sorted({s for v in source.values() for s in v}, key=lambda s: (s is None, s or ""))
    whole = defaultdict(int)
    for r in docs.collect():
        whole[r.source] += len(words(r.text))
    goal = dict(zip(names, mixing.targets([whole[n] for n in names])))
    again = {}
    for r in docs.select("doc_id", "source", "text").collect():
        again.setdefault((r.doc_id, len(words(r.text))), r.source)
    per = defaultdict(int)
    for r in rows:
        per[again[r.doc_id, r["size"]]] += r.taken
    for n in names:
        assert abs(per[n] - goal[n]) <= 2 * mixing.BLOCK_WORDS, n
    assert mixing.taken_words(docs).exceptAll(mixing.taken_words(docs.repartition(5))).count() == 0
    assert mixing.taken_words(empty(spark)).count() == 0


def test_mixed_documents_hold_what_is_taken(spark):
    docs = both(spark)
    out = mixing.mixed_documents(docs)
    assert out.schema == docs.schema
    rows = out.collect()
    assert sum(len(words(r.text)) for r in rows) == sum(r.taken for r in mixing.taken_words(docs).collect())
    text = defaultdict(list)
    for r in docs.collect():
        text[r.doc_id].append(Counter(words(r.text)))
    for r in rows:
        assert r.n_chars == len(r.text)
        assert any(not Counter(words(r.text)) - c for c in text[r.doc_id])
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_curve_visits_neighbours(spark):
    grid = spark.range(16).selectExpr("cast(id as int) x")
    cells = grid.crossJoin(grid.selectExpr("x y")).crossJoin(grid.selectExpr("x z"))
    rows = cells.withColumn("i", hilbert.curve_index([cells.x, cells.y, cells.z], 4)).orderBy("i").collect()
    assert [r.i for r in rows] == list(range(4096))
    for a, b in zip(rows, rows[1:]):
        assert abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1


def test_shards_are_even_runs_of_the_curve(spark):
    docs = both(spark)
    rows = hilbert.shard_rows(docs).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(16)]
    assert max(counts) - min(counts) <= 1
    ordered = [r.cell for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    key = lambda df: Counter(tuple(r) for r in df.collect())
    assert key(hilbert.shard_rows(docs)) == key(hilbert.shard_rows(docs.repartition(7)))
    assert hilbert.shard_rows(empty(spark)).count() == 0


def test_sharding_runs_no_python(spark):
    plan = hilbert.shard_rows(both(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards_hold_all_documents(spark, tmpdir_):
    docs = both(spark)
    hilbert.write_shards(docs.select("doc_id", "text", "lang", "source"), f"{tmpdir_}/shards", shards=4)
    back = spark.read.parquet(f"{tmpdir_}/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


def test_cuts_are_whole_and_nearly_full():
    for n in range(1, 3000):
        pieces = packing.cuts(n)
        assert sum(pieces) == n and all(pieces)
        for p in pieces:
            assert packing.CAPACITY / packing.class_of(p) - p <= packing.SLACK


def test_packing_holds_every_id_once(spark):
    docs = both(spark)
    source = docs.collect()
    ids = _ids("byte_bpe_50k.json", [r.text for r in source], packing.END_ID)
    by_doc = defaultdict(list)
    for r, i in zip(source, ids):
        by_doc[r.doc_id, len(i)].append(i)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(by_doc)
    for key, found in pieces.items():
        want = Counter()
        for own in by_doc[key]:
            at = 0
            for n in packing.cuts(len(own)):
                want[at, n, crc_words(own[at : at + n])] += 1
                at += n
        assert Counter(found) == want
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    total = sum(map(len, ids))
    assert len(bins) * packing.CAPACITY <= 1.03 * total + packing.CAPACITY
    assert packing.pack(empty(spark), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_codes_give_any_id():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        segment = dac.Segment(dac.pack_ids(ids))
        assert segment.all().tolist() == ids.tolist()
        assert [segment[i] for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        dac.Segment(dac.pack_ids(np.zeros(3, np.uint32)))[3]


def test_any_token_is_read_from_few_bytes(spark, tmpdir_, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_TOKENS", 30_000)
    docs, path = both(spark), f"{tmpdir_}/dac"
    dac.write_segments(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(docs.where("doc_id is not null").collect(), key=lambda r: r.doc_id)
    starts = {r.doc_id: r for r in dac.read_documents(spark, path).collect() if r.doc_id is not None}
    total = dac.read_documents(spark, path).agg({"n_tokens": "sum"}).first()[0]
    read = []

    class Counted(dac.Segment):
        def __init__(self, data):
            super().__init__(lambda at, n: (read.append(n), data(at, n))[1])

    monkeypatch.setattr(dac, "Segment", Counted)
    long = next(r for r in rows if r.doc_id == 12)
    ids = _ids("word_bpe_49k.json", [long.text], dac.END_ID)[0]
    assert starts[12].n_tokens == len(ids) > 50_000
    for i in (0, 1, 511, 512, 12_345, len(ids) - 2, len(ids) - 1):
        read.clear()
        assert dac.token_at(spark, path, starts[12].start + i) == ids[i]
        assert sum(read) <= 13 + 4 * (8 + 1 + 64 + 8)
    assert dac.token_at(spark, path, total - 1) == dac.END_ID
    for beyond in (-1, total):
        with pytest.raises(IndexError):
            dac.token_at(spark, path, beyond)


def test_files_of_lost_attempts_are_not_read(spark, tmpdir_):
    path = f"{tmpdir_}/dac"
    dac.write_segments(both(spark), path, public_tokenizers.path("word_bpe_49k.json"))
    want = dac.read_documents(spark, path).count()
    with open(f"{path}/ids/part-00000-lost.dac", "wb") as half:
        half.write(b"DAC1 and half a segment")
    assert dac.read_documents(spark, path).count() == want


def test_written_ids_come_back(spark, tmpdir_, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_TOKENS", 1000)
    docs = both(spark)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    ids = _ids("word_bpe_49k.json", [r.text for r in rows], dac.END_ID)
    path = f"{tmpdir_}/dac"
    dac.write_segments(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    found = sorted(dac.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r.doc_id for r in rows]
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter(
        (r.doc_id, len(i), crc_words(i)) for r, i in zip(rows, ids)
    )
    dac.write_segments(empty(spark), f"{tmpdir_}/none", public_tokenizers.path("word_bpe_49k.json"))
    assert dac.read_documents(spark, f"{tmpdir_}/none").count() == 0


def test_chunked_ids_equal_the_library():
    import random

    import pyarrow as pa

    from clickflow.llm.token_ids import Encoder

    rng = random.Random(2)
    signs = list("aAbzé×÷ßñ. ,'!?\n\t\r <>|=1٣ΑΣς中̸̇́İſ  \x0b\x85😀") + [
        "'s", "'re", "<|endoftext|>", "  ", "\n\n", " .",
    ]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = Encoder(public_tokenizers.path(name))
        want = _ids(name, texts, 0)
        for rows, block in text_blocks(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])):
            ids, begins = encoder.encode(block)
            assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == [w[:-1] for w in want]


def test_ids_of_added_tokens_equal_the_plain_library_call():
    import random

    import pyarrow as pa

    from clickflow.llm.token_ids import encoder

    rng = random.Random(3)
    signs = list("aAbé×ß ,'!?\n\t <>|1Σ中\u0338\u0307") + ["'s", "  ", "<|endof", "text|>", "<|startoftext|>"] + ["<|endoftext|>"] * 5
    texts = ["one <|endoftext|> two", "<|endof", "text|>", "", "<|ENDOFTEXT|>", "<|endoftext|>" * 3]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for name, first in (("word_bpe_49k.json", [637, 49407, 1237]), ("byte_bpe_50k.json", [505, 220, 50256, 734])):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert want[0] == first
        for rows, block in text_blocks(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])):
            ids, begins = encoder(public_tokenizers.path(name)).encode(block)
            assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == want


def test_a_filter_opens_few_files(spark, tmpdir_):
    import pyarrow.parquet as pq
    from pathlib import Path

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    hilbert.write_shards(docs, f"{tmpdir_}/pruned")
    files = sorted(Path(f"{tmpdir_}/pruned").rglob("*.parquet"))
    assert len(files) >= 16
    for column in ("source", "lang"):
        ranges = []
        for file in files:
            meta = pq.ParquetFile(file).metadata
            k = meta.schema.to_arrow_schema().get_field_index(column)
            found = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
            ranges.append((min(s.min for s in found), max(s.max for s in found)))
        # A name of most rows lies in most files, whatever the order.
        counts = docs.groupBy(column).count().collect()
        names = [r[0] for r in counts if r["count"] <= sum(c["count"] for c in counts) / 4]
        assert len(names) >= 3
        opened = [sum(lo <= n <= hi for lo, hi in ranges) for n in names]
        # A name lies in one half of its dimension; shards that reach over the middle add some.
        assert sum(opened) / len(opened) <= len(files) / 2 and max(opened) <= 0.6 * len(files), opened


def test_names_get_steps_in_code_point_order(spark):
    rows = [(i, "t", f"site-{n:03d}" if n else None, "é" * (n % 3)) for i, n in enumerate(list(range(40)) * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = [(r.source or "", r.s) for r in hilbert._with_steps(docs, "source", 16, "s").collect()]
    steps = [s for _, s in sorted(found)]
    assert steps == sorted(steps) and steps[0] == 0 and set(steps) == set(range(16))
    langs = hilbert._with_steps(docs, "lang", 16, "s").collect()
    assert len({r.s for r in langs}) == 3
    assert hilbert.with_cells(empty(spark)).count() == 0


def test_shards_keep_columns_of_any_name(spark, tmpdir_):
    docs = spark.createDataFrame(
        [(i, f"text {i}", "en", f"s{i % 3}", f"own{i}", i * 10, "x") for i in range(60)],
        "doc_id long, text string, lang string, source string, shard string, slot long, cell string",
    )
    hilbert.write_shards(docs, f"{tmpdir_}/named", shards=4)
    back = spark.read.parquet(f"{tmpdir_}/named")
    assert {(r.doc_id, r.doc_shard, r.doc_slot, r.doc_cell) for r in back.collect()} == {(i, f"own{i}", i * 10, "x") for i in range(60)}
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [15] * 4
