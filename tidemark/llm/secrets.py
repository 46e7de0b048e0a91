"""Secret scans: keywords first, anchored expressions near the hits, then checksums.

One Aho-Corasick pass over a text finds all keywords; an expression is only tried
where one of its keywords begins. Hexadecimal runs have no keyword and are found by
run lengths on the byte buffer. Kinds whose format embeds a checksum are reported
only if it is right:

- ``github``, ``npm``: prefix, 30 characters, CRC-32 of them in six base-62 digits
- ``xprv``: Base58Check extended private key, double SHA-256

Matches of a kind are leftmost and do not overlap; kinds may overlap each other.
Positions are code points, ends exclusive.

Defined cases: a null or empty text has no spans, and redaction leaves null as null;
repeated rows each give a row; redaction keeps all other columns as they are.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.scan import binary, blocks

# The base kinds' patterns and least lengths, and public token formats.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
EXTENDED = re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
BASE_KINDS = KINDS[:3]
MARK = "[SECRET]"

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def crc_digits(body: bytes) -> bytes:
    """CRC-32 in six base-62 digits."""
    left, out = zlib.crc32(body), []
    for _ in range(6):
        left, digit = divmod(left, 62)
        out.append(BASE62[digit])
    return bytes(reversed(out))


def base58check(token: bytes) -> bool:
    number = 0
    for c in token:
        number = number * 58 + BASE58.index(c)
    raw = number.to_bytes(82, "big") if number < 1 << 656 else b""
    body, tail = raw[:-4], raw[-4:]
    return bool(raw) and hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == tail


def _assign(data: bytes, at: int):
    m = ASSIGN.match(data, at)
    return m and (m.end(), len(m[2]) >= LEAST_ASSIGN)


def _access(data: bytes, at: int):
    m = ACCESS.match(data, at)
    return m and (m.end(), m.end() - at >= LEAST_ACCESS)


def _checked(data: bytes, at: int):
    m = CHECKED.match(data, at)
    return m and (m.end(), crc_digits(m[1]) == m[2])


def _extended(data: bytes, at: int):
    m = EXTENDED.match(data, at)
    return m and (m.end(), base58check(m[0]))


# keyword (in lower case) -> kind and what is tried where it begins
_NEAR = {
    **{k: ("assign", _assign) for k in ("password", "passwd", "secret", "token", "apikey", "api_key")},
    "akia": ("access", _access),
    **{f"gh{c}_": ("github", _checked) for c in "pousr"},
    "npm_": ("npm", _checked),
    "xprv": ("xprv", _extended),
}
_automaton = None


def _keywords() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for word, (kind, attempt) in _NEAR.items():
            _automaton.add_word(word, (len(word), kind, attempt))
        _automaton.make_automaton()
    return _automaton


def keyword_spans(data: bytes) -> list[tuple[str, int, int]]:
    """Spans in bytes of all kinds that have keywords."""
    # one character a byte, so that positions stay; bytes.lower() only lowers A-Z
    lowered = data.lower().decode("latin-1")
    hits: dict[str, list] = {}
    for last, (length, kind, attempt) in _keywords().iter(lowered):
        hits.setdefault(kind, []).append((last - length + 1, attempt))
    out = []
    for kind, places in hits.items():
        free = 0
        for at, attempt in sorted(places, key=lambda p: p[0]):
            if at >= free and (found := attempt(data, at)):
                free, good = found
                if good:
                    out.append((kind, at, free))
    return out


_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))


def hex_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the long runs of lower-case hexadecimal digits, by position."""
    flag = _HEX[data]
    opens, closes = flag.copy(), flag.copy()
    opens[1:] &= ~flag[:-1]
    closes[:-1] &= ~flag[1:]
    full = offsets[:-1] < offsets[1:]
    head, tail = offsets[:-1][full], offsets[1:][full] - 1
    opens[head], closes[tail] = flag[head], flag[tail]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = ends - starts >= LEAST_HEX
    return starts[long], ends[long]


def scan(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
    """The spans of each text in bytes, by start and then kind."""
    out: list[list[tuple[str, int, int]]] = []
    for _, data, offsets in blocks(texts):
        raw = data.tobytes()
        starts, ends = hex_runs(data, offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        first = len(out)
        cuts = offsets.tolist()
        out += [keyword_spans(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
        for i, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
            out[first + i].append(("hex", a - cuts[i], b - cuts[i]))
    for spans in out:
        spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def _find(texts: pa.Array) -> pa.Array:
    texts = binary(texts)
    out = []
    for i, spans in enumerate(scan(texts)):
        if spans:
            data = texts[i].as_py()
            place = {k: len(data[:k].decode()) for s in spans for k in s[1:]}
            spans = [{"kind": k, "start": place[a], "end": place[b]} for k, a, b in spans]
        out.append(spans)
    return pa.array(out, _SPAN_TYPE)


def _cover(texts: pa.Array) -> pa.Array:
    texts = binary(texts)
    found = scan(texts)
    if not any(found):
        return texts.cast(pa.string())
    mark, out = MARK.encode(), []
    for i, spans in enumerate(found):
        data = texts[i].as_py()
        if spans:
            parts, at = [], 0
            for _, a, b in spans:
                if a >= at:
                    parts += [data[at:a], mark]
                at = max(at, b)
            data = b"".join([*parts, data[at:]])
        out.append(data)
    return pa.array(out, pa.binary()).cast(pa.string())


def secret_spans(text: Column) -> Column:
    """All spans of a text column, by start and then kind."""
    return arrow_udf(_find, SPANS)(F.coalesce(text, F.lit("")).cast("binary"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans), one row per document."""
    return docs.select("doc_id", secret_spans(F.col("text")).alias("spans"))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every span, or run of overlapping spans, replaced by a mark."""
    cover = arrow_udf(_cover, "string")
    return docs.withColumn("text", cover(F.col("text").cast("binary")))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
