"""Byte-level BPE through the tokenizers library, piece by piece.

The library takes most of its time on words it has met before. Texts are therefore
cut where a cut cannot change the result, and the ids of each distinct piece are
remembered, in two generations of bounded size: a piece seen lately is found in the
young one or moved there from the old one, and when the young one is full the old
one is dropped.

A cut before a space is safe unless the space stands inside or at the end of a longer
run of white space: the pattern that splits text before the merges puts a space with
the word behind it, and no token crosses the pattern's splits. Texts that have such
a space are handed to the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

REMEMBER = 400_000  # pieces of one generation, at about 200 bytes each

# a space with white space before it and white space or nothing behind
_INSIDE = re.compile(r"\s (?:\s|\Z)")

# The byte-level pattern that splits text before the merges, for texts of
# ASCII and the Latin letters below; on these it does not depend on a Unicode version.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[{_LETTERS}\t\n\v\f\r\x20-\x7e]*")
_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printing Latin-1 characters stand for themselves, the other bytes in their order
    for the code points from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = byte_letters()


def lettered(text: str) -> str:
    """A text's UTF-8 bytes as the letters that stand for them."""
    return text.encode().decode("latin-1").translate(_BYTE_LETTERS)


@lru_cache(maxsize=2)
def encoder(path: str, width: int) -> PieceEncoder:
    """One encoder a worker process and vocabulary; width: bytes of an id."""
    return PieceEncoder(path, width)


class Memo(dict):
    """A dict that computes what it lacks, in two generations of bounded size."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    def __init__(self, path: str, width: int, remember: int = REMEMBER):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width, self.code = width, {2: "H", 4: "I"}[width]
        if self.library.get_vocab_size(True) > 1 << (8 * width):
            raise ValueError(f"ids of {path} do not fit {width} bytes")
        self.merge = self.library.model.tokenize
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.after_space = Memo(lambda piece: self._piece(" " + piece), remember)
        self.bare = Memo(self._merged, remember // 4)

    def _packed(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _merged(self, word: str) -> bytes:
        """Ids of what the pattern does not split."""
        return self._packed([t.id for t in self.merge(lettered(word))])

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _piece(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self._whole(text)
        words = _SPLIT.findall(text)
        if len(words) == 1:
            return self._merged(text)
        return b"".join(
            self.after_space[w[1:]] if w[0] == " " and len(w) > 1 and w[1] != " " else self.bare[w]
            for w in words
        )

    def encode(self, text: str) -> bytes:
        """The ids as little-endian integers, as the library gives them."""
        if _INSIDE.search(text):
            return self._whole(text)
        head, *tail = text.split(" ")
        return self._piece(head) + b"".join(map(self.after_space.__getitem__, tail))


def ids_array(encoded: list[bytes], width: int) -> pa.Array:
    """Encoded texts as an Arrow array of lists of 32-bit integers."""
    kind = np.dtype(f"<u{width}")
    flat = np.frombuffer(b"".join(encoded), kind).astype(np.int32)
    cuts = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(e) // kind.itemsize for e in encoded], out=cuts[1:])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
