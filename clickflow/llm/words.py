"""Words of whole texts as numpy arrays, with polynomial hashes of words and word spans.

A word is a run of bytes other than space and 0x09-0x0D (``[^\\x20\\x09-\\x0D]+``). The
separators are ASCII, so splitting the UTF-8 bytes equals splitting the characters.

Bytes are hashed eight at a time, each step mixing what was read before: no structure of the
bytes carries over to the hash. Spans of words are polynomials modulo 2**64 over such hashes,
so that any span is the difference of two prefix sums; they are for spans of up to a few dozen
words, as polynomials modulo a power of two fail on some sequences of 1,024 symbols and more.
Spans that decide a result use two hashes, over words hashed with different seeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled at once; a single longer text is a block of its own.
BLOCK_BYTES = 1 << 19

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` pseudorandom 64-bit values fixed by ``seed``."""
    start = (seed * 0x9E3779B97F4A7C15) % 2**64
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(start))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def reserve(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(n - 1, b, U64)]))
                for b in (self.base, self.inverse)
            )


SPAN_POWERS = (Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB))
#: Spans of more bytes are few, and hashed one by one.
LONG_SPAN = 256
#: The first bytes of a little-endian lane.
_LANE_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)], U64)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the spans ``data[starts:ends]``, one for each ``seed``."""
    sizes = ends - starts
    out = mix(sizes.astype(U64) + seeded(seed + 2, 1))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    odd, add = seeded(seed + 3, 2) | U64(1)
    live = np.flatnonzero((sizes > 0) & (sizes <= LONG_SPAN))
    at, left = starts[live], sizes[live]
    while len(live):
        lane = lanes[at]
        short = left < 8
        lane[short] &= _LANE_MASKS[left[short]]
        out[live] = mix((out[live] ^ lane) * odd + add)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > LONG_SPAN):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=seed)
    return out


class Spans:
    """Hashes of spans of a symbol sequence, from prefix sums."""

    def __init__(self, symbols: np.ndarray, powers: Powers) -> None:
        powers.reserve(len(symbols) + 1)
        self.powers = powers
        self.sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * powers.up[: len(symbols)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.powers.down[starts])


class Texts:
    """The bytes of a few texts end to end, and where their words lie."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.bounds = data, bounds
        n = len(data)
        self.in_word = ~((data == 0x20) | ((data >= 9) & (data <= 13)))
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        before = np.empty(n, bool)
        before[1:] = ~self.in_word[:-1]
        before[:1] = True
        after = np.empty(n, bool)
        after[:-1] = ~self.in_word[1:]
        after[-1:] = True
        self.starts = np.flatnonzero(self.in_word & (before | cut[:-1]))
        self.ends = np.flatnonzero(self.in_word & (after | cut[1:])) + 1
        #: Text i has the words first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, bounds)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def word_hashes(self, seed: int = 0) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends, seed)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.n_words)

    def window_starts(self, n: int) -> np.ndarray:
        """Words at which a window of ``n`` words of one text starts."""
        ends = np.repeat(self.first[1:], self.n_words)
        at = np.arange(len(self.starts))
        return at[at + n <= ends]


def text_blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of ``batch`` with the words of ``column``; a null text counts as empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    texts = pa.array([], pa.large_string()) if len(texts) == 0 else texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        lo, hi = int(bounds[at]), int(bounds[to])
        yield batch.slice(at, to - at), Texts(data[lo:hi], bounds[at : to + 1] - lo)
        at = to


def covered(n_words: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of ``n_words`` words lie in a window from ``starts``."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    # A table of low bits first, so that the search runs only over likely hits.
    table = np.zeros(1 << 20, bool)
    low = U64((1 << 20) - 1)
    table[(twice & low).astype(np.int64)] = True
    found = table[(keys & low).astype(np.int64)]
    likely = np.flatnonzero(found)
    twice = np.unique(twice)
    place = np.minimum(np.searchsorted(twice, keys[likely]), len(twice) - 1)
    found[likely] = twice[place] == keys[likely]
    return found


def as_long(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))
