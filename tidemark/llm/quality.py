"""Quality rules: distribution divergence against language references.

Two histograms of each document are held against those of its language: bytes by
character class, and words by the language's common words (all others together).
The references are counted over all documents. A document whose Jensen-Shannon
distance to its reference is too large is rejected, but only if it is long enough
for its histogram to mean something.

How long that is follows from sampling noise: n draws from a reference of b bins have a
squared distance of about (b - 1) / (8 ln 2 n) to it. Words count from the length on at
which this is no more than the divergence allowed (``MAX_WORD_DISTANCE`` squared), which
for 15 common words are 68, and the limit then still grows by ``NOISE_WEIGHT`` times the
noise. Characters count from where the noise is a twentieth of what is allowed.

Languages go by the first part of their code in lower case, of two or three letters:
``EN`` and ``en-US`` are ``en``.

Defined cases: a null or empty text has no words and fails the base rules; a null
or unusual language code is held against the reference of all such documents;
repeated rows each give a row. Input columns other than the three named are kept
out of the way: results hold only what is listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.scan import Block, blocks, repeated, later_copies, windows
from tidemark.plans import durable

CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "other", "wide")
SYMBOLS = b"#*$%&|<>"
COMMON_SHARE = 0.005  # of a language's words; so at most 200 words are common
MIN_WORDS, MAX_REPEATED_PCT = 50, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.2
CLASS_NOISE, NOISE_WEIGHT = 0.05, 1.5
PER_DRAW = 1 / (8 * np.log(2))  # a bin's share of the noise of one draw


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("space", (9, 10, 11, 12, 13, 32)),
        ("point", b".,;:'\"!?()-"),
        ("symbol", SYMBOLS),
        ("wide", range(192, 256)),  # the first byte of a longer character
    ):
        table[list(chars)] = CLASSES.index(name)
    table[128:192] = len(CLASSES)  # the other bytes of longer characters: not counted
    return table


_CLASS = _class_table()
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def language(lang):
    """The first part of a code, of two or three letters; everything else is one group."""
    first = F.substring_index(F.substring_index(F.lower(lang), "-", 1), "_", 1)
    usual = first.rlike(r"^[a-z]{2,3}\z")
    return F.when(usual, first).otherwise("und")


def class_counts(block: Block) -> np.ndarray:
    n, k = len(block.offsets) - 1, len(CLASSES) + 1
    doc = np.repeat(np.arange(n) * k, np.diff(block.offsets))
    return np.bincount(doc + _CLASS[block.data], minlength=n * k).reshape(n, k)[:, :-1]


BASE = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint"
)


def base_counts(block: Block) -> list[np.ndarray]:
    """The columns of BASE, by text."""
    n = len(block.offsets) - 1
    starts, ends, line_doc = block.lines()
    later = later_copies(block.hashes(starts, ends), line_doc)
    keys, at = windows(block.words(), block.doc, 3)
    marked = np.zeros(len(block.starts) + 2, bool)
    hit = at[repeated(keys, block.doc[at])]
    for k in range(3):
        marked[hit + k] = True
    return [
        block.n_words,
        block.per_doc(block.word & _FIRST_BYTE[block.data]),
        block.per_doc(_IS_SYMBOL[block.data]),
        np.bincount(line_doc[later], minlength=n),
        np.bincount(block.doc[marked[:-2]], minlength=n),
    ]


def partial_references(batches):
    """Counts of classes and words by language, of one task's documents.

    Words stand for their hash; sums are handed on whenever they have grown large.
    """

    def flush(words, classes):
        for lang, pairs in words.items():
            keys = np.concatenate([k for k, _ in pairs])
            counts = np.concatenate([c for _, c in pairs])
            keys, where = np.unique(keys, return_inverse=True)
            total = np.bincount(where, counts).astype(np.int64)
            yield lang, "word", keys.view(np.int64), total
            yield lang, "class", np.arange(len(CLASSES)), classes[lang]

    def rows(lang, kind, keys, counts):
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                pa.array([kind] * n, pa.string()),
                pa.array(keys, pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            ["lang", "kind", "item", "n"],
        )

    words: dict[str, list] = {}
    classes: dict[str, np.ndarray] = {}
    held = 0
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for first, data, offsets in blocks(batch.column("text")):
            block = Block(data, offsets)
            hashes, by_doc = block.words(lower=True), class_counts(block)
            names = langs[first : first + len(offsets) - 1]
            for lang in set(names):
                mine = names == lang
                classes[lang] = classes.get(lang, 0) + by_doc[mine].sum(axis=0)
                pair = np.unique(hashes[mine[block.doc]], return_counts=True)
                words.setdefault(lang, []).append(pair)
                held += len(pair[0])
            if held > 2_000_000:
                for part in flush(words, classes):
                    yield rows(*part)
                words, classes, held = {}, {}, 0
    for part in flush(words, classes):
        yield rows(*part)


def references(docs: DataFrame, share: float = COMMON_SHARE) -> DataFrame:
    """(lang, kind, item, n, total): class counts, and counts of the common words.

    At most 18,253 languages with 1 / share words and eight classes each.
    """
    source = docs.select(language(F.col("lang")).alias("lang"), F.col("text").cast("binary").alias("text"))
    counts = (
        source.mapInArrow(partial_references, "lang string, kind string, item bigint, n bigint")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    counts = durable(counts)
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), ["lang", "kind"]).where(
        (F.col("kind") == "class") | (F.col("n") >= F.lit(share) * F.col("total"))
    )


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, so 0 to 1) of each row to the reference."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / max(reference.sum(), 1)
    middle = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / middle), 0.0).sum(axis=1)

    return np.sqrt(np.maximum((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0.0))


def _scorer(tables):
    """tables: a broadcast {lang: (class counts, sorted word hashes, word counts, all words)}."""

    @arrow_udf(f"{BASE}, n_chars bigint, class_distance double, word_distance double, n_common bigint")
    def score(text: pa.Array, lang: pa.Array) -> pa.Array:
        langs = np.array(lang.to_pylist(), dtype=object)
        parts: list[list[np.ndarray]] = []
        for first, data, offsets in blocks(text):
            block = Block(data, offsets)
            n = len(offsets) - 1
            by_class, hashes = class_counts(block), block.words(lower=True)
            names = langs[first : first + n]
            near = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
            for name in set(names):
                mine = np.flatnonzero(names == name)
                class_ref, keys, key_counts, total = tables.value[name]
                near[0][mine] = distance(by_class[mine], class_ref)
                k = len(keys)
                slot = np.searchsorted(keys, hashes)
                known = slot < k
                known[known] = keys[slot[known]] == hashes[known]
                slot[~known] = k
                seen = np.bincount(block.doc * (k + 1) + slot, minlength=n * (k + 1))
                word_ref = np.append(key_counts, total - key_counts.sum())
                near[1][mine] = distance(seen.reshape(n, k + 1)[mine], word_ref)
                near[2][mine] = k
            parts.append([*base_counts(block), by_class.sum(axis=1), *near])
        names = [f.split()[0] for f in BASE.split(", ")]
        names += ["n_chars", "class_distance", "word_distance", "n_common"]
        if not parts:  # an empty batch
            none = np.zeros(0, np.int64)
            parts = [[none] * 6 + [np.zeros(0)] * 2 + [none]]
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names)

    return score


def reference_tables(refs: DataFrame) -> dict:
    """The references as arrays; their size has a fixed bound (see references): 58 MB."""
    found = refs.select("lang", "kind", "item", "n", "total").orderBy("lang", "kind").toArrow()
    lang, kind = (np.array(found.column(c).to_pylist(), object) for c in ("lang", "kind"))
    item, n, total = (found.column(c).to_numpy() for c in ("item", "n", "total"))
    tables = {}
    first = np.flatnonzero(np.append(True, lang[1:] != lang[:-1])) if len(lang) else []
    for a, b in zip(first, [*first[1:], len(lang)]):
        word = np.flatnonzero(kind[a:b] == "word") + a
        by_class = np.zeros(len(CLASSES))
        at = np.flatnonzero(kind[a:b] == "class") + a
        by_class[item[at]] = n[at]
        keys = item[word].astype(np.uint64)
        order = np.argsort(keys)
        counted = total[word[0]] if len(word) else 0
        tables[lang[a]] = by_class, keys[order], n[word][order], counted
    return tables


def divergence_rules(
    docs: DataFrame,
    max_class: float = MAX_CLASS_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    share: float = COMMON_SHARE,
) -> DataFrame:
    """Base counts, both distances and the verdict, one row per document.

    ``kept`` is false if a base rule fails, else if a distance is above its limit
    and the document has the length from which that distance counts.
    """
    spark = docs.sparkSession
    empty = np.zeros(len(CLASSES)), np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    tables = reference_tables(references(docs, share))

    score = _scorer(spark.sparkContext.broadcast(_Default(tables, empty)))
    scored = docs.select(
        "doc_id",
        score(F.col("text").cast("binary"), language(F.col("lang"))).alias("s"),
    ).select("doc_id", "s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")
    )
    class_noise = F.lit((len(CLASSES) - 1) * PER_DRAW) / F.greatest("n_chars", F.lit(1))
    word_noise = F.col("n_common") * PER_DRAW / F.greatest("n_words", F.lit(1))
    strange = (
        (class_noise <= CLASS_NOISE * max_class**2) & (F.col("class_distance") > max_class)
    ) | (
        (word_noise <= max_word**2)
        & (F.col("word_distance") > F.sqrt(F.lit(max_word**2) + NOISE_WEIGHT * word_noise))
    )
    return scored.withColumns({"base_failed": failed, "kept": ~failed & ~strange}).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"),
    )


class _Default(dict):
    """A dict with one value for all other keys; it can be pickled."""

    def __init__(self, items, other):
        super().__init__(items)
        self.other = other

    def __missing__(self, key):
        return self.other

    def __reduce__(self):
        return _Default, (dict(self), self.other)
