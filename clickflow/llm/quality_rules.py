"""Quality rules by repetition coverage.

Per text, rolling hashes of word n-grams of several lengths find the n-grams that occur
more than once; the characters of the words that later occurrences cover, and of repeated
lines, are measured against all word characters. A text is rejected when one share passes
its limit, when symbols crowd out words, or when the base rules fail. Each text is judged alone, so no shuffle runs.

Defined results: a null, empty or wordless text has zero counts and fails the base rule
on length; repeated rows each get their own row; extra columns of any name do not matter;
an empty table gives an empty result. A very long text is
one numpy block; memory is about 60 bytes per byte of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickflow.llm.shared import small_batches
from clickflow.llm.words import Spans, SPAN_POWERS, Texts, U64, byte_hashes, covered, mix, repeated, text_blocks

#: Largest tolerated share of word characters inside n-grams that repeat an earlier one of
#: the same text, by n. Only later occurrences count, so that one boilerplate line printed
#: twice does not cost a short text its place.
NGRAM_LIMITS = {5: 0.35, 6: 0.34, 7: 0.33, 8: 0.32, 9: 0.31, 10: 0.30}
#: Largest tolerated share of word characters inside lines that repeat an earlier one.
LINE_LIMIT = 0.30
#: Largest tolerated number of symbols per word.
SYMBOL_LIMIT = 0.3
MIN_WORDS = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ngram_char_share double, dup_line_char_share double"
)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """The counts and verdicts of every text of a block, as arrays."""
    n_texts, n_words = len(texts.bounds) - 1, texts.n_words
    chars = ((texts.data & 0xC0) != 0x80) & texts.in_word
    word_chars = _per_text(chars, texts.bounds)
    n_symbols = _per_text(SYMBOLS[texts.data], texts.bounds)
    of_word = texts.text_of_word()
    salt = mix(np.arange(n_texts, dtype=U64) + U64(1))
    char_sums = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(chars, out=char_sums[1:])
    chars_of_word = char_sums[texts.ends] - char_sums[texts.starts]

    # Lines are cut at \n and at the ends of texts; those with a word count.
    newline = np.flatnonzero(texts.data == 10)
    starts = np.unique(np.concatenate([texts.bounds[:-1], newline + 1]))
    starts = starts[starts < len(texts.data)]
    next_newline = np.append(newline, len(texts.data))[np.searchsorted(newline, starts)]
    of_line = np.searchsorted(texts.bounds, starts, "right") - 1
    ends = np.minimum(next_newline, texts.bounds[of_line + 1])
    line_chars = char_sums[ends] - char_sums[starts]
    full = line_chars > 0
    starts, ends, of_line, line_chars = starts[full], ends[full], of_line[full], line_chars[full]
    keys = byte_hashes(texts.data, starts, ends) ^ salt[of_line]
    firsts = np.zeros(len(keys), bool)
    firsts[np.unique(keys, return_index=True)[1]] = True
    n_dup_lines = np.bincount(of_line[~firsts], minlength=n_texts)
    dup_line_chars = np.bincount(of_line[~firsts], line_chars[~firsts], minlength=n_texts)

    spans = Spans(texts.word_hashes(), SPAN_POWERS[0])

    def in_repeats(n: int, later_only: bool) -> np.ndarray:
        at = texts.window_starts(n)
        keys = spans(at, at + n) ^ salt[of_word[at]]
        again = repeated(keys)
        at, keys = at[again], keys[again]
        if later_only:
            at = np.delete(at, np.unique(keys, return_index=True)[1])
        return covered(len(of_word), at, n)

    n_repeat_words = np.bincount(of_word[in_repeats(3, later_only=False)], minlength=n_texts)
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)
    whole = np.maximum(word_chars, 1)
    shares = {}
    for n in NGRAM_LIMITS:
        inside = in_repeats(n, later_only=True)
        shares[n] = np.bincount(of_word[inside], chars_of_word[inside], minlength=n_texts) / whole
    line_char_share = dup_line_chars / whole
    rejected = np.zeros(n_texts, bool)
    for n, most in NGRAM_LIMITS.items():
        rejected |= shares[n] > most
    rejected |= line_char_share > LINE_LIMIT
    rejected |= n_symbols > SYMBOL_LIMIT * n_words
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "base_failed": base_failed,
        "kept": ~(base_failed | rejected),
        "ngram_char_share": shares[min(NGRAM_LIMITS)],
        "dup_line_char_share": line_char_share,
    }


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id`` of every row with its counts, shares, ``base_failed`` and ``kept``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_blocks(batch):
                found = measure(texts)
                arrays = [rows.column(0), *[pa.array(v) for v in found.values()]]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *found])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_blocks(batch):
                yield rows.filter(pa.array(measure(texts)["kept"]))

    return small_batches(docs).mapInArrow(run, docs.schema)
