"""BPE encoding by forced cuts, and decoding.

No token of a vocabulary holds a byte pair that none of its tokens holds: between two
such bytes every encoding has a cut, so what lies on either side is encoded alone and
the ids are concatenated. Cuts at white space come first (no token holds any), then
the vocabulary's splitting pattern, then the byte pairs inside a word. Pieces between
white space, and fragments between cuts, are remembered up to a bounded number.

A vocabulary whose words end in a mark merges the last fragment of a word with it and
the others without.

Defined cases: a null text is encoded as an empty one; special tokens in a text are
recognised as the tokenizers library does by default; repeated rows each give a row;
only the id and text columns are read. Ids that the vocabulary lacks decode to nothing.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tidemark.llm.pieces import Memo, ids_array, lettered
from tidemark.llm.scan import binary

REMEMBER = 200_000  # pieces of one generation; a quarter as many fragments of each kind

# The vocabulary's splitting pattern, for texts of ASCII and these Latin
# letters, on which normalisation only lowers letters.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def inner_pairs(vocabulary, suffix: str) -> frozenset[str]:
    """All pairs of neighbouring byte letters inside a token."""
    out = set()
    for token in vocabulary:
        plain = token.removesuffix(suffix)
        out.update(map(str.__add__, plain, plain[1:]))
    return frozenset(out)


def fragments(word: str, pairs: frozenset[str]) -> list[str]:
    """A word cut between letters that no token has side by side."""
    cuts = [i + 1 for i, p in enumerate(map(str.__add__, word, word[1:])) if p not in pairs]
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]


class ForcedEncoder:
    def __init__(self, path: str, remember: int = REMEMBER):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ends = self.library.model
        self.inside = BPE(vocab=model["vocab"], merges=merges) if self.suffix else self.ends
        self.pairs = inner_pairs(model["vocab"], self.suffix)
        added = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        size = self.library.get_vocab_size(True)
        self.tokens = [self.library.id_to_token(i) or "" for i in range(size)]
        self.pieces = Memo(self._piece, remember)
        self.last = Memo(lambda f: tuple(t.id for t in self.ends.tokenize(f)), remember // 4)
        self.other = Memo(lambda f: tuple(t.id for t in self.inside.tokenize(f)), remember // 4)

    def _word(self, word: str) -> tuple[int, ...]:
        *front, end = fragments(word, self.pairs)
        if not front:
            return self.last[end]
        return sum((self.other[f] for f in front), ()) + self.last[end]

    def _piece(self, data: bytes) -> bytes:
        text = data.decode()
        if any(s in text for s in self.special):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return pack(ids)
        if _PLAIN.fullmatch(text):
            words = map(lettered, _WORDS.findall(text.lower()))
        else:
            plain = self.library.normalizer.normalize_str(text)
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return pack([i for w in words for i in self._word(w)])

    def encode(self, data: bytes) -> bytes:
        """Ids as little-endian 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, data.split()))

    def decode(self, ids) -> str:
        size = len(self.tokens)
        return " ".join([self.tokens[i] for i in ids if 0 <= i < size])


def pack(ids) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> ForcedEncoder:
    return ForcedEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids), one row per document."""

    def encode(texts: pa.Array) -> pa.Array:
        own = _encoder(path)
        return ids_array([own.encode(t.as_py() or b"") for t in binary(texts)], 4)

    encode = arrow_udf(encode, "array<int>")
    return docs.select("doc_id", encode(F.col("text").cast("binary")).alias("ids"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text that its ids decode to."""

    def decode(ids: pa.Array) -> pa.Array:
        own, flat = _encoder(path), ids.values.to_numpy()
        cuts = ids.offsets.to_numpy()
        return pa.array(
            [own.decode(flat[a:b].tolist()) for a, b in zip(cuts, cuts[1:])], pa.string()
        )

    return encoded.withColumn("decoded", arrow_udf(decode, "string")("ids"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): encoding and decoding in one pass over the texts.

    Two functions in a row would encode twice, as Spark merges them into
    encode(text) and decode(encode(text)).
    """

    def both(texts: pa.Array) -> pa.Array:
        own = _encoder(path)
        encoded, decoded = [], []
        for text in binary(texts):
            ids = own.encode(text.as_py() or b"")
            encoded.append(ids)
            decoded.append(own.decode(memoryview(ids).cast("I")))
        return pa.StructArray.from_arrays(
            [ids_array(encoded, 4), pa.array(decoded, pa.string())], ["ids", "decoded"]
        )

    both = arrow_udf(both, "struct<ids:array<int>,decoded:string>")
    return docs.select("doc_id", both(F.col("text").cast("binary")).alias("t")).select(
        "doc_id", "t.*"
    )
