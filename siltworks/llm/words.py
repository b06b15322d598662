"""Words of many texts at once, as numpy arrays of 64-bit hashes.

Texts stay UTF-8 bytes.  A word is a maximal run of word bytes, so a class that treats all bytes
from 0x80 up alike works on bytes as it does on characters.  Work runs over slices of about a
million bytes that end between words, so memory does not grow with the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
GRAM_BASE = 0xD1342543DE82EF95

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words parted by ASCII white space.
NOT_SPACE = ~SPACE
#: Digits, small Latin letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SLICE)
        inverse = pow(BASE, -1, 1 << 64)
        _powers[:] = [np.concatenate([[U64(1)], np.cumprod(np.full(size - 1, b, U64))]) for b in (BASE, inverse)]
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins; a null text counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


class Words:
    """Words of a column of texts.

    ``hashes``: one per word; ``first``: index of each text's first word, with the total at the end;
    ``begin`` and ``end``: byte places of words in ``data``.
    """

    def __init__(self, texts, inside: np.ndarray = NOT_SPACE, fold: np.ndarray = SAME):
        self.data, self.text_at = text_bytes(texts)
        n = len(self.data)
        edge = np.zeros(n + 1, bool)  # places where a text begins: words never run over them
        edge[self.text_at] = True
        begins, ends, hashes, lo = [], [], [], 0
        while lo < n:
            hi = min(lo + SLICE, n)
            while hi < n:  # to the next place between words
                stop = np.flatnonzero(~inside[fold[self.data[hi:hi + 4096]]] | edge[hi:min(hi + 4096, n)])
                if len(stop):
                    hi += int(stop[0])
                    break
                hi = min(hi + 4096, n)
            part = fold[self.data[lo:hi]]
            word, cut = inside[part], edge[lo:hi]
            before = np.concatenate([[False], word[:-1]])
            after = np.concatenate([word[1:] & ~cut[1:], [False]])
            b, e = np.flatnonzero(word & (~before | cut)), np.flatnonzero(word & ~after) + 1
            power, inverse = _tables(hi - lo + 1)
            total = np.zeros(hi - lo + 1, U64)
            np.cumsum((part.astype(U64) + U64(1)) * power[:hi - lo], out=total[1:])
            hashes.append(mix((total[e] - total[b]) * inverse[b] + (e - b).astype(U64)))
            begins.append(b + lo)
            ends.append(e + lo)
            lo = hi
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.hashes, self.begin, self.end = join(hashes, U64), join(begins, np.int64), join(ends, np.int64)
        self.first = np.searchsorted(self.begin, self.text_at)

    def __len__(self) -> int:
        return len(self.hashes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def whole(self, length: int) -> np.ndarray:
        """True where ``length`` words from here on lie in one text."""
        stop = np.repeat(self.first[1:], self.counts)
        return np.arange(len(self)) + length <= stop


def grams(hashes: np.ndarray, length: int, base: int = GRAM_BASE) -> np.ndarray:
    """Hash of each run of ``length`` consecutive hashes; shorter by ``length - 1`` than its input."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n].copy()
    for j in range(1, length):
        out *= U64(base)
        out += hashes[j:n + j]
    return mix(out)


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def hash_word(word: str) -> int:
    """The hash that ``Words`` gives one word."""
    return int(Words(pa.array([word]), np.ones(256, bool)).hashes[0])
