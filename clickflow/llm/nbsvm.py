"""Quality scores by a support vector machine on naive Bayes features.

A text's features are indicators of its n-grams (byte trigrams and words, hashed into
``FEATURES`` places) and of a few shape marks (how much repeats, how long it and its lines
are). Each indicator is scaled by its log-count ratio between the classes, smoothed by
``ALPHA``; on these features a linear model with hinge loss is fitted by dual coordinate
descent, and a logistic curve, fitted on a part of the sample kept from the descent, turns
its margins into scores.

The model is fitted on at most ``SAMPLE`` labelled rows, taken by a hash of ``doc_id``; all
documents are scored, each from its whole text alone. The fit runs in one task, over
at most ``SAMPLE`` rows; the model, ``FEATURES`` numbers, goes to all tasks.

Defined results: null, empty and wordless texts have shape marks only and get the score
these give; rows whose label or id is null are not learned from; of several labels of one
document the smallest counts; without labels of both classes every score is 0.5. Repeated
rows get equal scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.shared import small_batches
from clickflow.llm.words import SPAN_POWERS, U64, Spans, Texts, covered, mix, repeated, text_blocks

FEATURES = 1 << 18
ALPHA = 1.0
COST = 0.02
EPOCHS = 12
SAMPLE = 8_000
CUT = 0.7
#: Every fifth sampled row fits the logistic curve, the others the margin.
HELD_EVERY = 5


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The first feature of every text (and the end), and the features, each once per text."""
    n_texts, data = len(texts.bounds) - 1, texts.data
    low = U64(FEATURES - 1)
    of_byte = np.repeat(np.arange(n_texts), np.diff(texts.bounds))
    wide = data.astype(U64)
    grams = np.empty(0, U64)
    of_gram = np.empty(0, np.int64)
    if len(data) >= 3:
        inside = of_byte[2:] == of_byte[:-2]
        grams = (wide[:-2] << U64(16) | wide[1:-1] << U64(8) | wide[2:])[inside]
        of_gram = of_byte[2:][inside]
    of_word = texts.text_of_word()
    words = texts.word_hashes()
    marks = _shape(texts, words, of_word)
    of = np.concatenate([of_gram, of_word, np.tile(np.arange(n_texts), len(marks))])
    hashed = np.concatenate([mix(grams), words, *[mix(m.astype(U64) + U64(1_000_003 * (k + 1))) for k, m in enumerate(marks)]])
    keys = np.unique(of.astype(U64) << U64(18) | (hashed & low))
    found = (keys >> U64(18)).astype(np.int64)
    return np.searchsorted(found, np.arange(n_texts + 1)), (keys & low).astype(np.int64)


def _shape(texts: Texts, words: np.ndarray, of_word: np.ndarray) -> list[np.ndarray]:
    """Marks of each text: tenths of words in repeated trigrams and of upper case letters and
    signs among characters, and powers of two of its words and of words per line."""
    n_texts, n_words = len(texts.bounds) - 1, texts.n_words
    spans = Spans(words, SPAN_POWERS[0])
    at = texts.window_starts(3)
    salt = mix(np.arange(n_texts, dtype=U64) + U64(1))
    at = at[repeated(spans(at, at + 3) ^ salt[of_word[at]])]
    again = np.bincount(of_word[covered(len(of_word), at, 3)], minlength=n_texts)

    def count(which: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(which))
        return sums[texts.bounds[1:]] - sums[texts.bounds[:-1]]

    d = texts.data
    chars = np.maximum(count(texts.in_word), 1)
    upper = count((d >= 0x41) & (d <= 0x5A))
    signs = count((d > 0x20) & (d < 0x7F) & ~(((d | 0x20) >= 0x61) & ((d | 0x20) <= 0x7A)))
    lines = count(d == 10) + 1
    tenth = lambda a, b: np.ceil(10 * a / b).astype(np.int64)
    return [
        tenth(again, np.maximum(n_words, 1)),
        tenth(upper, chars),
        tenth(signs, chars),
        np.log2(n_words + 1).astype(np.int64),
        np.log2(n_words / lines + 1).astype(np.int64),
    ]


def ratios(bounds: np.ndarray, found: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log-count ratio of every feature between good and bad texts."""
    of = np.repeat(good, np.diff(bounds))
    p = ALPHA + np.bincount(found[of], minlength=FEATURES)
    q = ALPHA + np.bincount(found[~of], minlength=FEATURES)
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(bounds: np.ndarray, found: np.ndarray, good: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights of the hinge-loss model on scaled indicators, by dual coordinate descent. The
    rarer class costs more, so that both weigh alike."""
    weights = np.zeros(FEATURES)
    y = np.where(good, 1.0, -1.0)
    share = np.where(good, good.mean(), 1 - good.mean())
    most = COST * 0.5 / share
    rows = [found[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    values = [scale[r] for r in rows]
    norms = np.array([max(v @ v, 1e-12) for v in values])
    dual = np.zeros(len(y))
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (weights[rows[i]] @ values[i]) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), most[i])
            if new != dual[i]:
                weights[rows[i]] += (new - dual[i]) * y[i] * values[i]
                dual[i] = new
    return weights * scale


def margins(bounds: np.ndarray, found: np.ndarray, model: np.ndarray) -> np.ndarray:
    sums = np.append(0.0, np.cumsum(model[found]))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def logistic(x: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to scores, by Newton's method on smoothed
    targets."""
    n_good, n_bad = int(good.sum()), int((~good).sum())
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    centre, spread = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([(x - centre) / spread, np.ones(len(x))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, z.T @ (p - target) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)


def fit(texts: list[str], good: np.ndarray) -> tuple[np.ndarray, float, float] | None:
    """Model, slope and offset from labelled texts; None without both classes."""
    column = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    bounds, found, at = [np.zeros(1, np.int64)], [], 0
    for _, block in text_blocks(column):
        b, f = features(block)
        bounds.append(b[1:] + at)
        found.append(f)
        at += len(f)
    bounds, found = np.concatenate(bounds), np.concatenate(found) if found else np.empty(0, np.int64)
    held = np.arange(len(good)) % HELD_EVERY == 0
    if min(int((good & held).sum()), int((~good & held).sum()), int((good & ~held).sum()), int((~good & ~held).sum())) < 1:
        return None

    def part(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(bounds)
        return np.append(0, np.cumsum(sizes[which])), found[np.repeat(which, sizes)]

    inner = part(~held)
    scale = ratios(*inner, good[~held])
    model = descend(*inner, good[~held], scale)
    slope, offset = logistic(margins(*part(held), model), good[held])
    return model, slope, offset


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, float] | None:
    """The model of at most ``sample`` labelled documents. ``labels``: doc_id, quality."""
    drawn = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` pairs of numbers: small enough to send to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    # One row of each id: an id that many rows share weighs as one label and sends one text.
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = [t or "" for t in table["text"].to_pylist()]
        model = fit(texts, table["quality"].to_numpy() == 1)
        if model is None:
            return pa.table({"model": pa.array([], pa.binary()), "slope": pa.array([], pa.float64()), "offset": pa.array([], pa.float64())})
        weights, slope, offset = model
        return pa.table({"model": [weights.astype("<f8").tobytes()], "slope": [slope], "offset": [offset]})

    rows = rows.select("doc_id", "text", "quality", F.lit(0).alias("all"))
    fitted = rows.groupBy("all").applyInArrow(run, "model binary, slope double, offset double").collect()
    if not fitted:
        return None
    return np.frombuffer(fitted[0]["model"], "<f8"), fitted[0]["slope"], fitted[0]["offset"]


def score(docs: DataFrame, model: tuple[np.ndarray, float, float] | None) -> DataFrame:
    """doc_id, score and predicted of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    weights, slope, offset = model if model is not None else (None, 0.0, 0.0)
    if weights is not None:
        weights = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_blocks(batch):
                x = np.zeros(len(rows))
                if weights is not None:
                    x = margins(*features(texts), weights.astype(np.float64))
                s = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")
