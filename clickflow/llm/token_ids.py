"""Token ids of whole texts, chunk by chunk.

Texts repeat a modest set of chunks (a word, a word with its leading space, a run of
punctuation), so a block of texts is cut into chunks, every different chunk is encoded
once by the tokenizers library, and the ids are put together again. Cuts are made only
where the tokenizers of this module's users cannot carry anything across:

* before a white space run that follows an ASCII sign or a Latin letter, and after a
  single tab or line end between two such characters; a space stays with the word after
  it, as byte-level tokenizers want;
* between a Latin letter and an ASCII punctuation sign after it (no apostrophe, which
  may begin a contraction).

A chunk that is one Latin word goes straight to the tokenizer's model, with the byte-level
alphabet applied, after a trial of that route against the whole tokenizer. Everything else, such as other scripts, combining marks or unusual white space, stays in
one chunk with its neighbours. The strings of added (special) tokens, which the library
finds in the raw text before all else, are chunks of their own, so ids equal the plain
library call's; an ``Encoder`` without ``added`` takes them as ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from clickflow.llm.words import U64, Texts, byte_hashes

#: Different chunks remembered by a worker before it starts afresh.
REMEMBERED = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_PUNCT = _SIGN & ~_LETTER
_PUNCT[0x30:0x3A] = False
_PUNCT[0x27] = False


ONE_WORD = re.compile("[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u023f]+")


def _byte_signs() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others, in order,
    for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_SIGNS = _byte_signs()


def chunk_starts(texts: Texts, whole: list[tuple[int, int]] | None = None) -> np.ndarray:
    """Byte positions at which chunks start; the spans ``whole`` are chunks of their own."""
    d = texts.data
    n = len(d)
    if not n:
        return np.empty(0, np.int64)
    # The lead bytes of U+00C0-U+023F, all of them letters but for the signs 00D7 and 00F7;
    # 0130 is left out as its lower case holds a combining mark.
    lead = (d >= 0xC3) & (d <= 0xC8)
    lead[:-1] &= ~((d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7)))
    lead[:-1] &= ~((d[:-1] == 0xC4) & (d[1:] == 0xB0))
    ends_letter = _LETTER[d]
    ends_letter[1:] |= lead[:-1]
    space = _SPACE[d]
    ends_known = ends_letter | _SIGN[d]
    starts_known = _SIGN[d] | lead
    single = space & (d != 0x20)
    single[1:] &= ends_known[:-1]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = (space[1:] & ends_known[:-1]) | (starts_known[1:] & single[:-1]) | (_PUNCT[d[1:]] & ends_letter[:-1])
    for start, end in whole or ():
        cut[start:end] = False
        cut[[start, end]] = True
    cut[texts.bounds] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """A tokenizer with the ids of the chunks it has met."""

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        # These tokenizers' added tokens are matched as they are, without regard to neighbours.
        names = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = re.compile(b"|".join(map(re.escape, sorted(names, key=len, reverse=True)))) if names else None
        self.tokenize = self.tokenizer.model.tokenize
        normalizer = self.tokenizer.normalizer
        # For the letters of ONE_WORD, normalisation is lower case or nothing (see the trial).
        self.lowers = normalizer is not None and normalizer.normalize_str("ÉA") == "éa"
        self.drops_space = self._whole([" a"]) == self._whole(["a"])
        trial = ["the", "The", "Zx", "éa", "Ñandú", " the", " Äxt", " qq", "straße"]
        self.by_model = [self._word(w) for w in trial] == self._whole(trial)
        self._forget()

    def _whole(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _word(self, chunk: str) -> list[int]:
        """The ids of one Latin word, perhaps with a space before it, from the model alone."""
        if self.drops_space:
            chunk = chunk.lstrip(" ")
        if self.lowers:
            chunk = chunk.lower()
        if not chunk.isascii():
            chunk = chunk.encode().decode("latin-1")
        return [t.id for t in self.tokenize(chunk.translate(BYTE_SIGNS))]

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        if not self.by_model:
            return self._whole(chunks)
        found = [self._word(c) if ONE_WORD.fullmatch(c) else None for c in chunks]
        rest = iter(self._whole([c for c, ids in zip(chunks, found, strict=True) if ids is None]))
        return [next(rest) if ids is None else ids for ids in found]

    def _forget(self) -> None:
        self.keys = np.empty(0, U64)
        self.checks = np.empty(0, U64)
        self.lengths = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, chunks: list[str]) -> None:
        """Adds chunks by their keys, which are in order, with a second hash of each."""
        found = self._encode(chunks)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.checks = np.insert(self.checks, at, checks)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.starts = np.insert(self.starts, at, starts)

    def _added_spans(self, texts: Texts) -> list[tuple[int, int]]:
        """Where the texts hold strings of added tokens."""
        if self.added is None or not self.added.search(texts.data):
            return []
        bounds = texts.bounds.tolist()
        return [m.span() for a, b in zip(bounds[:-1], bounds[1:]) for m in self.added.finditer(texts.data, a, b)]

    def _plain(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """What ``encode`` returns, by whole texts."""
        raw, bounds = texts.data.tobytes(), texts.bounds.tolist()
        found = self._whole([raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])])
        flat = np.fromiter((i for ids in found for i in ids), np.uint32)
        return flat, np.cumsum([0, *map(len, found)])

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin (and the end)."""
        starts = chunk_starts(texts, self._added_spans(texts))
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts.bounds), np.int64)
        ends = np.append(starts[1:], len(texts.data))
        keys, first, which = np.unique(byte_hashes(texts.data, starts, ends, 2), return_index=True, return_inverse=True)
        checks = byte_hashes(texts.data, starts, ends, 3)
        if len(self.keys) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        known = ~new
        if (checks != checks[first][which]).any() or (self.checks[place[known]] != checks[first][known]).any():
            return self._plain(texts)  # two chunks share a key
        if new.any():
            raw = texts.data.tobytes()
            at = first[new]
            self._learn(keys[new], checks[at], [raw[a:b].decode() for a, b in zip(starts[at], ends[at], strict=True)])
            place = np.searchsorted(self.keys, keys)
        lengths = self.lengths[place][which]
        to = np.cumsum(lengths)
        # Position k of the output lies k - (its chunk's first position) into the chunk's ids.
        source = np.repeat(self.starts[place][which] - (to - lengths), lengths) + np.arange(int(to[-1]))
        begins = np.append(0, to)[np.searchsorted(starts, texts.bounds)]
        return self.ids[source], begins


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """This worker's encoder for the tokenizer file at ``path``, equal to the plain library call."""
    return Encoder(path, added=True)
