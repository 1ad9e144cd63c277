"""Near-duplicate documents and vectors against brute force; classifier accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickflow.llm import cover_tree, nbsvm, weighted_minhash
from clickflow.llm.components import components
from clickflow.llm.words import text_blocks
from tests.llm.cases import SF, both, documents, empty, prose, words


def _classes(pairs, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    n = 60
    edges = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(30, i) for i in range(n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)],
        "none": [(4, 4)],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == _classes(real, {x for e in real for x in e})


def _weights(texts):
    """Shingle weights by the definition, with the operator's word buckets."""
    column = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    buckets = []
    for _, block in text_blocks(column):
        b = weighted_minhash.word_buckets(block).tolist()
        buckets += [b[x:y] for x, y in zip(block.first[:-1], block.first[1:])]
    df = Counter(x for b in buckets for x in set(b))
    total = max(2, len(texts))
    idf = {k: round(1000 * (1 + math.log(total / n) / math.log(total))) for k, n in df.items()}
    out = []
    for text, b in zip(texts, buckets):
        w, n = words(text), weighted_minhash.SHINGLE
        tf, weight = Counter(), {}
        for i in range(max(1, len(w) - n + 1) if w else 0):
            gram = tuple(w[i : i + n])
            tf[gram] += 1
            weight[gram] = sum(idf[x] for x in b[i : i + n]) / (1000 * len(gram))
        out.append({g: tf[g] * weight[g] for g in tf})
    return out


def _jaccard(x, y):
    low = sum(min(v, y[k]) for k, v in x.items() if k in y)
    return low / (sum(x.values()) + sum(y.values()) - low) if x and y else 0.0


def _brute_near(rows):
    texts = sorted({r.text or "" for r in rows})
    weights, holders = _weights([r.text or "" for r in rows]), defaultdict(list)
    of = {r.text or "": w for r, w in zip(rows, weights)}
    for i, t in enumerate(texts):
        for g in of[t]:
            holders[g].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = [(a, b) for a, b in pairs if _jaccard(of[texts[a]], of[texts[b]]) >= 0.8]
    top = _classes(links, range(len(texts)))
    members = defaultdict(list)
    for r in rows:
        members[top[texts.index(r.text or "")]].append(r.doc_id)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return Counter((r.doc_id, least[top[texts.index(r.text or "")]]) for r in rows)


def test_near_documents_match_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for family in range(12):
        base = prose(rng, 150, 3000).split()
        for copy in range(6):
            own = list(base)
            for _ in range(copy):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            rows.append((10_000 + 10 * family + copy, " ".join(own)))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    docs = both(spark).where("text is null or length(text) < 100000").unionByName(made, allowMissingColumns=True)
    found = weighted_minhash.near_duplicates(docs).collect()
    want = _brute_near(docs.collect())
    assert Counter((r.doc_id, r.class_id) for r in found) == want
    kept = {r.class_id for r in found if r.kept}
    assert kept == {r.class_id for r in found} and all(r.kept == (r.doc_id == r.class_id) for r in found if r.doc_id != 6)


def test_keep_one_and_empty(spark):
    docs = both(spark).where("text is null or length(text) < 100000")
    out = weighted_minhash.keep_one(docs)
    assert out.schema == docs.schema
    assert 0 < out.count() < docs.count()
    assert weighted_minhash.near_duplicates(empty(spark)).count() == 0


def test_large_band_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BLOCK", 16)
    monkeypatch.setattr(weighted_minhash, "OPEN_BLOCK", 4)
    rng = random.Random(4)
    base = prose(rng, 200, 3000).split()
    rows = []
    for i in range(70):
        own = list(base)
        own[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    found = weighted_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in found} == {0}


def test_open_members_are_compared_in_blocks(spark, monkeypatch):
    """Chains in which no document is near to all others: links must not be lost."""
    monkeypatch.setattr(weighted_minhash, "OPEN_BLOCK", 3)
    rng = random.Random(14)
    rows = []
    for chain in range(4):
        own = prose(rng, 200, 3000).split()
        for step in range(12):
            rows.append((100 * chain + step, " ".join(own)))
            for _ in range(3):
                own[rng.randrange(200)] = f"c{chain}s{rng.randrange(10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = weighted_minhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == _brute_near(docs.collect())


def test_sample_agreement_estimates_similarity():
    rng = random.Random(6)
    a = prose(rng, 400, 4000).split()
    b = a[:340] + prose(rng, 60, 4000).split()
    texts = [" ".join(a), " ".join(b)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    idf = np.full(weighted_minhash.IDF_BUCKETS, 1500)
    for _, block in text_blocks(batch):
        sig = weighted_minhash.signatures(weighted_minhash.Features(block, idf), weighted_minhash._variates())
    gram = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    true = len(gram(a) & gram(b)) / len(gram(a) | gram(b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.25


def test_near_copies_of_very_long_texts(spark):
    """Sections in another order, and a text without its first tenth."""
    rng = random.Random(15)
    rows = []
    for base in (0, 10):
        text = prose(rng, 200_000, 50_000).split()
        sections = [text[i : i + 5000] for i in range(0, len(text), 5000)]
        rng.shuffle(sections)
        texts = [text, [w for s in sections for w in s], text[len(text) // 10 :]]
        rows += [(base + i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = weighted_minhash.near_duplicates(docs).collect()
    want = _brute_near(docs.collect())
    assert Counter((r.doc_id, r.class_id) for r in found) == want == Counter((b + i, b) for b in (0, 10) for i in range(3))


def _vectors(seed, n, labels, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    rows = []
    for i in range(n):
        v = base[i] if i % 3 else base[i // 4] + rng.normal(scale=rng.choice([0.02, 0.1, 0.3]), size=dims)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(labels))))
    rows += [(n + k, rows[5][1], rows[5][2]) for k in range(4)]
    n += 4
    odd = [None, [], [0.0] * dims, [float("nan")] + [1.0] * (dims - 1), [float("inf")] * dims, [None] + [1.0] * (dims - 1)]
    rows += [(n + k, v, 0) for k, v in enumerate(odd)] + [(n + 10, rows[5][1], None), (n + 11, rows[5][1][:-1], rows[5][2])]
    return rows


@pytest.mark.parametrize("block", [2048, 24])
def test_vectors_match_brute_force(spark, block):
    rows = _vectors(1, 300, 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    real = {}
    for i, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0:
            real[i] = (label, np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [
        (a, b)
        for a in real for b in real
        if a < b and real[a][0] == real[b][0] and len(real[a][1]) == len(real[b][1]) and real[a][1] @ real[b][1] >= 0.93
    ]
    top, n = _classes(links, [r[0] for r in rows]), Counter(x for pair in links for x in pair)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(df, block=block).collect()}
    assert got == {r[0]: (n[r[0]], top[r[0]], top[r[0]] == r[0]) for r in rows}
    assert cover_tree.near_vectors(df.limit(0)).count() == 0


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8))
    points = np.repeat(centres, 20, axis=0) + rng.normal(scale=0.02, size=(800, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = cover_tree.CoverTree(points, 0.1)
    for level, (c, r) in enumerate(zip(tree.centres, tree.radii)):
        assert len(c) == len(r) and (level == 0 or set(tree.centres[level - 1]) <= set(c))
    compared = sum(len(x) * len(y) for x, y in cover_tree.leaf_pairs(tree, tree, 0.2))
    assert compared < 0.3 * len(points) ** 2


def test_classifier_is_accurate_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = docs.join(labels.select("doc_id", "quality"), "doc_id").limit(2500).cache()
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = nbsvm.train(docs, labels.where(fold != 2).select("doc_id", "quality"), sample=1500)
    rows = nbsvm.score(docs, model).join(docs, "doc_id").where(fold == 2).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.85


def test_classifier_edge_cases(spark):
    docs = both(spark)
    labels = spark.createDataFrame([(1006, 1), (None, 0), (1007, None)], "doc_id long, quality int")
    assert nbsvm.train(docs, labels) is None
    rows = nbsvm.score(docs, None).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.5}
    assert nbsvm.score(empty(spark), None).count() == 0
    texts = [prose(random.Random(i), 30) + (" !!!! ####" if i % 2 else "") for i in range(60)] + ["", " "]
    model = nbsvm.fit(texts, np.array([i % 2 == 0 for i in range(62)]))
    scored = nbsvm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    good = {r.doc_id: r.score for r in scored.collect()}
    assert np.mean([good[i] for i in range(0, 60, 2)]) > 0.8 > 0.2 > np.mean([good[i] for i in range(1, 60, 2)])


def test_dealt_queries_read_sf_tables(spark):
    from clickflow.llm.queries import queries

    docs = documents(spark).count()
    rows = {  # those of the tables that are not documents
        "op9_cover_tree": spark.read.parquet(f"{SF}/embeddings.parquet").count(),
        "op11_conversation_repair": spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count(),
        "op12_warc": spark.read.parquet(f"{SF}/pages.parquet").count(),
    }
    for name, query in queries().items():
        df = query(spark, SF)
        n = df.count()
        if name == "op7_packing":
            assert df.select("doc_id").distinct().count() == docs
        elif name == "op13_lexical_search":
            assert 0 < df.select("item_id").distinct().count() and df.groupBy("item_id").count().agg({"count": "max"}).first()[0] <= 50
        else:
            assert n == rows.get(name, docs), name


def test_repeated_ids_weigh_once_in_the_classifier(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, 60) if i % 2 else "zz qq " * 30) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + [rows[0]] * 5000, "doc_id long, text string").repartition(4)
    a, b = nbsvm.train(once, labels), nbsvm.train(often, labels)
    assert (a[0] == b[0]).all() and a[1:] == b[1:]
