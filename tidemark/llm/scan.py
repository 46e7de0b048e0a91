"""Words, lines and hashes of many texts at once, on flat byte buffers.

The operators that look at every word of every text share these helpers. Texts
arrive as an Arrow array; a handful of numpy passes over its byte buffer replaces
a Python loop over words. Words are the runs of bytes other than space and
0x09-0x0D, which in UTF-8 is the same as runs of those code points.

A word's hash is a polynomial of its bytes modulo 2**64, mixed afterwards, so that
every hash of a buffer follows from one running sum. Two different words share a
hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20  # texts are taken in runs of about this size

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``size`` of each."""
    global _powers
    if len(_powers[0]) < size:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = tables[0], tables[1]
    return _powers[0][:size], _powers[1][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixing bijection of 64-bit words (splitmix64's last step)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def binary(texts: pa.Array) -> pa.Array:
    """The texts as bytes, null as empty."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.binary())
    elif pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_binary())
    return texts


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, n + 1 offsets into them) of runs of texts."""
    texts = binary(texts)
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return
    wide = pa.types.is_large_binary(texts.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    offsets = np.frombuffer(
        texts.buffers()[1], kind, len(texts) + 1, texts.offset * width
    ).astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = offsets[first : last + 1]
        yield first, whole[part[0] : part[-1]], part - part[0]
        first = last


class Block:
    """The words of one run of texts.

    ``starts``, ``ends``: byte positions of the words; ``doc``: the text of each;
    ``first``: n + 1 positions of each text's words among all.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~_SPACE[data]
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        full = offsets[:-1] < offsets[1:]  # words do not run on into the next text
        head, tail = offsets[:-1][full], offsets[1:][full] - 1
        opens[head] = word[head]
        closes[tail] = word[tail]
        self.word = word
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._sums: dict[bool, np.ndarray] = {}

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def _sum(self, lower: bool) -> np.ndarray:
        if lower not in self._sums:
            data = _LOWER[self.data] if lower else self.data
            powers, _ = _power_tables(len(data) + 1)
            sums = np.zeros(len(data) + 1, np.uint64)
            values = data.astype(np.uint64)
            values += np.uint64(1)
            values *= powers[:-1]
            np.cumsum(values, out=sums[1:])
            self._sums[lower] = sums
        return self._sums[lower]

    def hashes(self, starts, ends, lower: bool = False) -> np.ndarray:
        """One hash for each byte range; ``lower``: A-Z count as a-z."""
        sums = self._sum(lower)
        _, inverse = _power_tables(len(self.data) + 1)
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def words(self, lower: bool = False) -> np.ndarray:
        return self.hashes(self.starts, self.ends, lower)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How often a flag of a byte is set, by text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, text) of the \\n-split lines that hold a word."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([breaks, self.offsets[1:]])
        starts.sort()
        ends.sort()
        # a break right at a text's end opens an empty line there; both lists
        # stay aligned because each text adds one start and one end
        has = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends = starts[has], ends[has]
        doc = np.searchsorted(self.offsets, starts, "right") - 1
        return starts, ends, doc


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of each window inside one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return out[at], at


def repeated(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each key whether its text holds it twice or more."""
    if not len(keys):
        return np.zeros(0, bool)
    both = mix(keys + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(both, kind="stable")
    sorted_ = both[order]
    same = sorted_[1:] == sorted_[:-1]
    flag = np.zeros(len(keys), bool)
    flag[1:] |= same
    flag[:-1] |= same
    out = np.empty(len(keys), bool)
    out[order] = flag
    return out


def later_copies(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each key whether its text held it before."""
    both = mix(keys + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    out = np.ones(len(keys), bool)
    out[np.unique(both, return_index=True)[1]] = False
    return out
