"""Lexical search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from clickflow.llm import lexical_search as search
from clickflow.llm.shared import shared_folder
from tests.llm.cases import SCHEMA, both, empty, odd_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string, key string, rank int"


def _terms(text):
    return TERM.findall((text or "").translate(FOLD))


def _expected(docs, items, top):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    df = Counter(t for _, c in counts for t in c)
    n, words = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    out = Counter()
    for item, text in set(items):
        scored = []
        for doc, c in counts:
            score, m = 0, 50 + (50 * c.total() * n) // max(words, 1)
            for t in set(_terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1):
            out[item, rank, doc, -score] += 1
    return out


def _got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in df.collect())


def _items(rng, docs):
    items = []
    for i in range(25):
        text = " ".join(_terms(rng.choice(docs)[1])[:400]) or "la"
        items.append((i, " ".join(rng.sample(text.split(), min(12, len(text.split())))).upper()))
    items += [(3, "Naïve WÖRDS é"), (3, "Naïve WÖRDS é"), (90, None), (91, ""), (92, "nowhere-seen"), (None, "la one two")]
    return items


def test_search_equals_plain_scoring(spark):
    docs = both(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = _items(random.Random(8), rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    assert _got(search.rank_documents(docs, df)) == _expected(rows, items, search.TOP)
    assert _got(search.rank_documents(docs, df, top=3)) == _expected(rows, items, 3)


def test_items_in_blocks_agree(spark, monkeypatch):
    docs = both(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = _items(random.Random(9), rows)[:6]
    monkeypatch.setattr(search, "BLOCK_TERMS", 30)
    df = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    assert _got(search.rank_documents(docs, df, top=5)) == _expected(rows, items, 5)


def test_hot_copies_and_ties(spark):
    rows = [(i % 400 if i % 7 else None, "alpha beta beta gamma") for i in range(900)] + [(1000 + i, f"alpha d{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = [(1, "Beta alpha"), (2, "d7 alpha")]
    df = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    assert _got(search.rank_documents(docs, df)) == _expected(rows, items, search.TOP)


def test_totals_are_never_less_than_scores(spark):
    rng = random.Random(10)
    words = [b"w%d" % i for i in range(300)]
    docs = [[rng.choice(words[: rng.choice([5, 300])]) for _ in range(rng.choice([1, 20, 900]))] for _ in range(70)]
    terms = words[:120]
    items = search.Items(
        terms, [np.arange(120), np.arange(3)], [np.arange(1, 121), np.array([5, 7, 9])], len(docs), sum(map(len, docs))
    )
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(docs))), "text": [b" ".join(d) for d in docs]})
    schema, _ = search._index_schema(spark.createDataFrame([], "doc_id long"))
    seen = 0
    for out in search._index_task(schema)(iter([batch])):
        for block in out.to_pylist():
            for item, total in search._upper_bounds(items, block, search._hashed(terms), {}):
                for doc_id, most in zip(block["doc_ids"], total):
                    doc = docs[doc_id]
                    c, m = Counter(doc), 50 + (50 * len(doc) * items.documents) // items.words
                    score = sum(int(w) * search.part(c[terms[u]], m) for u, w in zip(items.uses[item], items.weights[item]) if c[terms[u]])
                    assert most >= score
                    seen += 1
    assert seen == 2 * len(docs)


def test_index_serves_any_search_and_rules_most_out(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(1, 400)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = search.build_index(docs, shared_folder(spark, "index"))
    for seed in (1, 2):
        items = [(i, rows[random.Random(seed * 9 + i).randrange(1500)][1][:200]) for i in range(4)]
        df = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
        assert _got(search.search(index, df, top=5)) == _expected(rows, items, 5)
    reached = looked = 0
    for block in index.collect():
        text = _terms(rows[7][1])
        n, words = len(rows), sum(len(_terms(t)) for _, t in rows)
        terms = sorted(set(text))
        df = Counter(t for _, d in rows for t in set(_terms(d)))
        weights = np.array([search.term_weight(n, df[t]) for t in terms])
        one = search.Items([t.encode() for t in terms], [np.arange(len(terms))], [weights], n, words)
        # Half of the best score keeps less than half of the documents.
        floor = max(score for _, _, _, score in _expected(rows, [(0, rows[7][1])], 5)) // 2
        for _, total in search._upper_bounds(one, block.asDict(), search._hashed(one.terms), {}):
            looked, reached = looked + len(total), reached + int((total >= floor).sum())
    assert reached < looked / 2


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "la", "x", 1)], ITEMS)
    assert search.rank_documents(empty(spark), items).count() == 0
    assert search.rank_documents(spark.createDataFrame(odd_rows(), SCHEMA), items.where("false")).count() == 0
