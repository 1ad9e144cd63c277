"""Near-duplicate documents by improved consistent weighted sampling.

A document is its five-word shingles weighted by TF-IDF: the shingle's count in the text
times the mean IDF of its words. IDF comes from the document frequencies of all words of
all documents, hashed into ``IDF_BUCKETS`` counters, a table of fixed size; it runs from
1 (in every document) to 2. Each document gets ``SAMPLES`` improved consistent weighted
samples (Ioffe's scheme: Gamma(2, 1) and uniform variates fixed by the shingle), whose
agreement estimates weighted Jaccard similarity. ``ROWS`` samples form a band; documents
that share a band and agree in ``AGREE`` samples are candidates, and a candidate pair is a
link if its exact weighted Jaccard similarity is at least ``threshold``. Classes are the
connected components of links.

Texts that are equal collapse first, by partial aggregation, so copies never form pairs.
No round lists the pairs of a band. The first proposes for each member its best connected
partner only. In the second, members with a candidate in another class are compared with
each other inside tasks, by an index of their shingles, and a task returns only links that
join classes. Every candidate pair is thus verified or implied by verified links. Bands over
``BLOCK`` members, and over ``OPEN_BLOCK`` open ones, are compared block against block in
separate tasks.

Defined results: null texts count as empty. Texts of one to four words have one shingle,
all their words; texts without words are near only to equal texts. Rows that repeat a
``doc_id`` with an equal text are one document and share its verdict. A null ``doc_id`` is
never a class id while the class has another. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.components import components
from clickflow.llm.shared import small_batches, written
from clickflow.llm.words import SPAN_POWERS, U64, Spans, Texts, mix, repeated, seeded, text_blocks

SHINGLE = 5
THRESHOLD = 0.8
#: Samples, samples in a band, and agreeing samples of a candidate pair: a pair at 0.8 shares
#: a band with probability 0.9998 and agrees in enough samples with probability 0.999.
SAMPLES, ROWS, AGREE = 36, 3, 21
IDF_BUCKETS = 1 << 18
#: IDF in thousandths, so that sums over a shingle's words are exact.
UNIT = 1000
#: Members of a band compared in one task.
BLOCK = 4096
#: Members still open after the first round whose texts are compared in one task.
OPEN_BLOCK = 1024


def node_of(text: Column) -> Column:
    """16 bytes that stand for a whole text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("node")


def word_buckets(texts: Texts) -> np.ndarray:
    return (texts.word_hashes() >> U64(64 - IDF_BUCKETS.bit_length() + 1)).astype(np.int64)


def word_idf(docs: DataFrame) -> np.ndarray:
    """IDF of every word bucket in thousandths, from all documents. ``IDF_BUCKETS`` numbers
    come to the driver, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(IDF_BUCKETS, np.int64), 0
        for batch in batches:
            for _, texts in text_blocks(batch):
                n += len(texts.bounds) - 1
                pairs = np.unique(texts.text_of_word() * IDF_BUCKETS + word_buckets(texts))
                df += np.bincount(pairs % IDF_BUCKETS, minlength=IDF_BUCKETS)
        full = np.flatnonzero(df)
        # Bucket -1 carries the number of documents.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1).astype(np.int32)), pa.array(np.append(df[full], n))], ["bucket", "n"]
        )

    rows = small_batches(docs.select("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    df = np.ones(IDF_BUCKETS)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    total = max(int(n[bucket < 0].sum()), 2)
    return np.rint(UNIT * (1 + np.log(total / df).clip(0) / np.log(total))).astype(np.int64)


class Features:
    """The distinct shingles of a block's texts with their weights, text by text."""

    def __init__(self, texts: Texts, idf: np.ndarray) -> None:
        n_texts, n_words = len(texts.bounds) - 1, texts.n_words
        of_word = texts.text_of_word()
        sums = np.zeros(len(of_word) + 1, np.int64)
        np.cumsum(idf[word_buckets(texts)], out=sums[1:])
        spans = Spans(texts.word_hashes(), SPAN_POWERS[0])
        starts = texts.window_starts(SHINGLE)
        ends = starts + SHINGLE
        short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
        if len(short):
            starts = np.concatenate([starts, texts.first[short]])
            ends = np.concatenate([ends, texts.first[short + 1]])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
        hashes, of = spans(starts, ends), of_word[starts] if len(starts) else np.empty(0, np.int64)
        idf_mean = (sums[ends] - sums[starts]) / (UNIT * (ends - starts))
        keys = hashes ^ mix(np.arange(n_texts, dtype=U64) + U64(1))[of]
        again = np.flatnonzero(repeated(keys))
        counts = np.ones(len(keys), np.int64)
        _, first, n = np.unique(keys[again], return_index=True, return_counts=True)
        counts[again] = 0
        counts[again[first]] = n
        kept = np.flatnonzero(counts)
        self.hashes, self.of = hashes[kept], of[kept]
        self.weights = counts[kept] * idf_mean[kept]
        self.totals = np.bincount(self.of, self.weights, minlength=n_texts)
        #: Text i has the features first[i] to first[i + 1].
        self.first = np.searchsorted(self.of, np.arange(n_texts + 1))


def _variates() -> np.ndarray:
    """For each sample the salt under which a shingle's hash gives its variates."""
    return seeded(100, SAMPLES)


def _gamma(bits: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) variates from 64 bits each: minus the log of two uniforms' product, above 0."""
    u = (bits.view(np.uint32).reshape(-1, 2).astype(np.float32) + np.float32(0.5)) * np.float32(2**-32)
    return np.maximum(-np.log(u[:, 0]) - np.log(u[:, 1]), np.float32(2**-26))


def signatures(features: Features, variates: np.ndarray) -> np.ndarray:
    """``SAMPLES`` 32-bit samples for every text with a feature; rows of zeros for the rest.
    Every shingle has variates of its own; should two tie, the smaller hash is sampled."""
    out = np.zeros((len(features.first) - 1, SAMPLES), np.uint32)
    full = np.flatnonzero(np.diff(features.first))
    if not len(full):
        return out
    starts = features.first[full]
    row = np.repeat(np.arange(len(full)), np.diff(features.first)[full])
    log_w = np.log(features.weights).astype(np.float32)
    for j, salt in enumerate(variates):
        x = mix(features.hashes ^ salt)
        beta = ((x * U64(0x9E3779B97F4A7C15)) >> U64(40)).astype(np.float32) * np.float32(2**-24)
        r = _gamma(x)
        t = np.floor(log_w / r + beta)
        a = np.log(_gamma(mix(x))) - r * (t - beta + 1)
        best = np.flatnonzero(a == np.minimum.reduceat(a, starts)[row])
        best = best[np.lexsort((features.hashes[best], row[best]))]
        best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
        picked = features.hashes[best] ^ mix(t[best].astype(np.int64).view(U64) + U64(j))
        out[full, j] = (mix(picked) >> U64(32)).astype(np.uint32)
    return out


def _signed(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(node, total, signature, bands) of every different text with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        variates = _variates()
        for batch in batches:
            for rows, texts in text_blocks(batch):
                features = Features(texts, idf)
                sig = signatures(features, variates)
                keep = np.flatnonzero(features.totals > 0)
                sig = sig[keep]
                bands = sig.reshape(len(keep), SAMPLES // ROWS, ROWS).astype(U64)
                keys = np.zeros(bands.shape[:2], U64) + np.arange(bands.shape[1], dtype=U64)
                for k in range(ROWS):
                    keys = mix(keys) ^ bands[:, :, k]
                keys = mix(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(rows.schema.get_field_index("node")).take(pa.array(keep)),
                        pa.array(features.totals[keep]),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(keep) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())
                        ),
                    ],
                    ["node", "total", "signature", "bands"],
                )

    return small_batches(docs.select(node_of(F.col("text")), "text")).mapInArrow(
        run, "node binary, total double, signature binary, bands array<long>"
    )


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """``members`` (with the ``size`` of their group) with own, x, y: a member of block i
    goes to the tasks (min(i, j), max(i, j)) of all blocks j of its group."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("other")


def _agreeing(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (both ways) of a task's members that agree in enough samples."""
    total, own = table["total"].to_numpy(), table["own"].to_numpy()
    sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(len(total), SAMPLES)
    left, right = [], []
    step = max(1, (1 << 22) // max(len(total), 1))
    for lo in range(0, len(total), step):
        part = slice(lo, lo + step)
        agree = np.zeros((len(sig[part]), len(total)), np.uint8)
        for j in range(SAMPLES):
            agree += sig[part, j, None] == sig[None, :, j]
        near = agree >= AGREE
        # Jaccard similarity is at most the ratio of the totals.
        near &= np.minimum(total[part, None], total) >= (threshold - 1e-9) * np.maximum(total[part, None], total)
        if table["x"][0] != table["y"][0]:
            near &= own[part, None] != own
        i, k = np.nonzero(near)
        i += lo
        left.append(i[i != k])
        right.append(k[i != k])
    return np.concatenate(left), np.concatenate(right)


def _candidates(members: DataFrame, threshold: float) -> DataFrame:
    """One pair for each member of a band (band, node, total, signature, size): with its
    candidate partner that has the most candidates itself; ties go to the first."""

    def pairs(table: pa.Table) -> pa.Table:
        node = table["node"].combine_chunks()
        i, k = _agreeing(table, threshold)
        degree = np.bincount(i, minlength=len(node))
        order = np.lexsort((k, -degree[k], i))
        firsts = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
        return pa.table({"a": node.take(pa.array(i[firsts])), "b": node.take(pa.array(k[firsts]))})

    found = _dealt(members, BLOCK).groupBy("band", "x", "y").applyInArrow(pairs, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open_members(members: DataFrame, threshold: float) -> DataFrame:
    """The members that have a candidate partner in another class so far (``label``), with
    their band and block pair (band, bx, by) and the number of such members there."""

    def still_open(table: pa.Table) -> pa.Table:
        i, k = _agreeing(table, threshold)
        labels = np.unique(table["label"].to_pylist(), return_inverse=True)[1] if len(i) else np.empty(0, np.int64)
        rows = pa.array(np.unique(i[labels[i] != labels[k]]) if len(i) else np.empty(0, np.int64))
        out = table.select(["node", "label", "band", "x", "y"]).take(rows).rename_columns(["node", "label", "band", "bx", "by"])
        return out.append_column("size", pa.array(np.full(len(rows), len(rows), np.int64)))

    return (
        _dealt(members, BLOCK)
        .groupBy("band", "x", "y")
        .applyInArrow(still_open, "node binary, label binary, band long, bx int, by int, size long")
    )


def _cross_links(open_members: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Links between different classes among the open members of a band: every pair is
    compared, inside tasks, through an index of the members' shingles; a task returns only
    the links that join classes."""

    def compare(table: pa.Table) -> pa.Table:
        node, own = table["node"].combine_chunks(), table["own"].to_numpy()
        label = np.unique(table["label"].to_pylist(), return_inverse=True)[1]
        keys, weights, of, totals, n = [], [], [], [], 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for _, block in text_blocks(batch):
                f = Features(block, idf)
                keys.append(f.hashes)
                weights.append(f.weights)
                of.append(f.of + n)
                totals.append(f.totals)
                n += len(f.totals)
        keys, weights, of, total = (np.concatenate(v) for v in (keys, weights, of, totals))
        order = np.argsort(keys, kind="stable")
        keys, by_weight, by_member = keys[order], weights[order], of[order]
        low = np.searchsorted(keys, keys, "left")
        count = np.searchsorted(keys, keys, "right") - low
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        bounds = np.searchsorted(of, np.arange(n + 1))
        group = np.arange(int(label.max()) + 1)
        two = table["x"][0] != table["y"][0]

        def top(g: int) -> int:
            while group[g] != g:
                g = group[g]
            return int(g)

        a, b = [], []
        for i in range(n):
            mine = place[bounds[i] : bounds[i + 1]]
            mine = mine[count[mine] > 1]
            times = count[mine]
            at = np.repeat(low[mine] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            shared = np.bincount(
                by_member[at], np.minimum(by_weight[at], np.repeat(by_weight[mine], times)), minlength=n
            )
            hit = (shared > 0) & (shared >= (threshold - 1e-9) * (total[i] + total - shared)) & (label != label[i])
            if two:
                hit &= own != own[i]
            for k in np.flatnonzero(hit):
                x, y = top(label[i]), top(label[k])
                if x != y:
                    group[max(x, y)] = min(x, y)
                    a.append(i)
                    b.append(k)
        return pa.table({"a": node.take(pa.array(a, pa.int64())), "b": node.take(pa.array(b, pa.int64()))})

    dealt = _dealt(open_members, OPEN_BLOCK).join(texts, "node")
    return dealt.groupBy("band", "bx", "by", "x", "y").applyInArrow(compare, "a binary, b binary")


def _links(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Those of ``pairs`` whose texts reach the threshold. ``texts``: node, text."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                rows = batch.slice(at, 64)
                sides = pa.concat_arrays([rows.column(2), rows.column(3)])
                block = pa.RecordBatch.from_arrays([sides], ["text"])
                n = len(rows)
                # Both sides' features under their pair's salt: a key met twice is shared.
                keys, weights, pair, totals = [], [], [], []
                for part, texts in text_blocks(block):
                    f = Features(texts, idf)
                    which = (sum(len(t) for t in totals) + f.of) % n
                    keys.append(f.hashes ^ mix(which.astype(U64) + U64(1)))
                    weights.append(f.weights)
                    pair.append(which)
                    totals.append(f.totals)
                    del part
                keys, weights, pair = np.concatenate(keys), np.concatenate(weights), np.concatenate(pair)
                total = np.concatenate(totals)
                order = np.argsort(keys, kind="stable")
                same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
                x, y = order[same], order[same + 1]
                shared = np.bincount(pair[x], np.minimum(weights[x], weights[y]), minlength=n)
                union = total[:n] + total[n:] - shared
                hit = np.flatnonzero((union > 0) & (shared >= (threshold - 1e-9) * union))
                yield pa.RecordBatch.from_arrays([rows.column(k).take(pa.array(hit)) for k in (0, 1)], ["a", "b"])

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, root) after further links: only the classes that these join move."""
    ends = links
    for c in ("a", "b"):
        known = labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        ends = ends.join(known, c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    upper = written(components(ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))), "labels")
    fresh = upper.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    top = upper.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return labels.union(fresh).join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _verdicts(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, node, class_id, kept) for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    idf = word_idf(docs)
    signed = written(_signed(docs, idf).distinct(), "signatures")
    banded = signed.select("node", F.explode("bands").alias("band"))
    # Written first: a join on top of an aggregate could not be split where a band is large.
    shared = written(banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "bands")
    members = written(banded.join(shared, "band").join(signed.drop("bands"), "node"), "members")

    ids = docs.select("doc_id", node_of(F.col("text")))
    first = ids.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    near = members.select("node").distinct()
    wanted = first.join(near, "node").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    texts = docs.select("doc_id", "text", node_of(F.col("text")))
    same = texts["doc_id"].eqNullSafe(wanted["_id"]) & (texts["node"] == wanted["_node"])
    texts = written(texts.join(wanted, same, "leftsemi").select("node", "text"), "texts")

    links = written(_links(_candidates(members, threshold), texts, idf, threshold), "links")
    labels = written(components(links), "labels")
    labelled = members.join(labels.withColumnRenamed("root", "label"), "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    still_open = written(_open_members(labelled, threshold), "open")
    more = written(_cross_links(still_open, texts, idf, threshold).distinct(), "links")
    if not more.isEmpty():
        labels = written(_merged(labels, more), "labels")

    roots = first.join(labels, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    # Both written: a join on top of the aggregate could not be split where a class is large.
    roots = written(roots, "roots")
    named = roots.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("best"))
    named = written(named, "named")
    classes = roots.join(named, "root").select(
        F.col("node").alias("_node"), F.col("best.doc_id").alias("class_id"), F.col("best.node").alias("_kept")
    )
    return ids.join(classes, ids["node"] == classes["_node"]).select(
        "doc_id",
        "node",
        "class_id",
        (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("_kept"))).alias("kept"),
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, kept) for every row of ``docs``; ``class_id`` is the smallest
    ``doc_id`` of the class, ``kept`` marks the document that stays."""
    return _verdicts(docs, threshold).drop("node")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class: of the rows that repeat the kept document, the
    smallest. Partial aggregation collapses these, so no task gets all of them."""
    kept = _verdicts(docs, threshold).where("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).distinct()
    # Columns go by number meanwhile, so that no name of theirs can clash.
    columns = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    doc_id, text = (f"c{columns.index(c)}" for c in ("doc_id", "text"))
    rows = rows.withColumn("node", node_of(F.col(text)))
    same = rows[doc_id].eqNullSafe(kept["_id"]) & (rows["node"] == kept["_node"])
    whole = F.struct(*[c for c in rows.columns if c != "node"])
    one = rows.join(kept, same, "leftsemi").groupBy(doc_id, "node").agg(F.min(whole).alias("row"))
    return one.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)])
