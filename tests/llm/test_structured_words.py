"""Long words, lines and chunks of a structure on which polynomial hashes fail."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickflow.llm import quality_rules, substrings, token_ids
from clickflow.llm.words import byte_hashes, text_blocks
from tests.llm.cases import prose, words


def _thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def _pairs():
    for n in (1024, 2048, 4096):
        for a, b in (("a", "b"), ("x", "y")):
            yield _thue_morse(n, a, b), _thue_morse(n, b, a)


def test_hashes_differ_and_depend_on_the_seed():
    rng = random.Random(1)
    texts = [w for p in _pairs() for w in p] + ["", "a", "aa", "a\0", "\0", "\0\0", "abcdefgh", "abcdefghi", "x" * 256, "x" * 257]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(20))) for _ in range(500)]
    texts = sorted(set(texts))
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    one, two = (byte_hashes(data, starts, ends, seed) for seed in (0, 1))
    assert len(set(one.tolist())) == len(texts) == len(set(two.tolist()))
    assert not (one == two).any()
    # A span's hash depends on its bytes alone, not on where it stands.
    moved = np.concatenate([np.frombuffer(b"odd", np.uint8), data])
    assert (byte_hashes(moved, starts + 3, ends + 3) == one).all()


def test_substrings_tell_structured_words_apart(spark):
    rows = []
    for i, (u, v) in enumerate(_pairs()):
        rest = prose(random.Random(i), 34, 10**9)
        rows += [(2 * i, f"{u} {rest}"), (2 * i + 1, f"{v} {rest}")]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in found] == [0] * len(rows)


def test_lines_and_words_in_quality_rules(spark):
    rows, want = [], {}
    for i, (u, v) in enumerate(_pairs()):
        rows.append((i, f"{u}\n{v}\n{u} one two\n{v} one two"))
        w = words(rows[-1][1])
        counts = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        want[i] = (0, len({k + j for k in range(len(w) - 2) if counts[tuple(w[k : k + 3])] > 1 for j in range(3)}))
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in got.collect()} == want


def _texts(texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_string())})
    return [t for _, t in text_blocks(batch)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_ids_of_structured_words(name, monkeypatch):
    path = public_tokenizers.path(name)
    texts = [f"{u} and {v}" for u, v in _pairs()] + ["plain words, twice: plain words"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]

    def ids(encoder):
        out = []
        for block in _texts(texts):
            flat, begins = encoder.encode(block)
            out += [flat[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]
        return out

    assert ids(token_ids.Encoder(path, added=True)) == want
    # Were two chunks to share a key, their second hashes would send the texts to the library.
    real = token_ids.byte_hashes
    monkeypatch.setattr(
        token_ids, "byte_hashes", lambda d, s, e, seed: real(d, s, e, seed) % np.uint64(7) if seed == 2 else real(d, s, e, seed)
    )
    assert ids(token_ids.Encoder(path, added=True)) == want
