"""Filter interaction audit: what each filter removes in every order of the filters.

Every text is read once by a finite-state transducer over its UTF-8 bytes. A table
gives, for each state (between words, inside a word) and byte, the next state and what
the byte counts as: a word's begin, a word's end, a code point, a capital, a symbol.
The next state does not depend on the state before, so a block of bytes takes all its
transitions at once by table lookup; a text starts between words, and its end closes a
word that is still open.

The word spans are inserted into an open-addressing hash table, all texts of a block
together. A span that meets another one in its slot counts as the same word only if
both lie in one text and their bytes are equal; otherwise it goes on to the next slot.
So the distinct words are exact whatever the hash does.

The filters are conditions over these measures; one of them, ``COPY``, is not about a
text alone but fails documents whose text a smaller doc_id has too. The rest of a
document's text is a function of the text, so copies are folded by their SHA-256, and a
document is reduced to the set of filters it fails. The audit of all orders then needs
only the counts of these sets in each part, whatever the number of documents.

Defined cases: a null text is an empty one; a null part is the empty string; a null
doc_id has no labels, is no copy of any and no text is a copy of it; rows that share
doc_id and text are copies of the smaller doc_ids only, not of each other; labels given
several times for one doc_id count if any of them is 1; an empty table gives no rows.
Other columns of the documents are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scan import Block, binary, blocks, mix

BETWEEN, INSIDE = 0, 1
OPENS, CLOSES, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
SYMBOLS = "#$%&*|"
COPY = "copy"  # stands for the condition on other documents; the others are SQL
PROBED_BYTES = 64  # words up to this length are compared eight bytes at a time

MEASURES = "n_words bigint, n_distinct bigint, n_capitals bigint, n_points bigint, n_symbols bigint"

FILTERS = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_capitals > 10 * n_points",
    "D": "n_symbols > 0",
    "E": COPY,
}


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state of a byte, what it counts as by 256 * state + byte)."""
    after = np.full(256, INSIDE, np.uint8)
    after[[0x20, *range(0x09, 0x0E)]] = BETWEEN
    out = np.zeros((2, 256), np.uint8)
    out[BETWEEN, after == INSIDE] |= OPENS
    out[INSIDE, after == BETWEEN] |= CLOSES
    for state in (BETWEEN, INSIDE):
        out[state] |= POINT
        out[state, 0x80:0xC0] &= ~np.uint8(POINT)  # bytes that continue a code point
        out[state, ord("A") : ord("Z") + 1] |= CAPITAL
        out[state, [ord(c) for c in SYMBOLS]] |= SYMBOL
    return after, out.ravel()


_AFTER, _OUT = transducer()


class Transduced(Block):
    """The transducer's output over one run of texts, and the words' hash table."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self._sums = data, offsets, {}
        full = offsets[:-1] < offsets[1:]
        after = _AFTER[data]
        state = np.empty_like(after)
        state[1:] = after[:-1]
        state[offsets[:-1][full]] = BETWEEN
        self.out = _OUT[(state.astype(np.uint16) << 8) + data]
        self.starts = np.flatnonzero(self.out & OPENS)
        last = offsets[1:][full]
        open_ = last[after[last - 1] == INSIDE]  # closed by the end of their text
        self.ends = np.sort(np.concatenate([np.flatnonzero(self.out & CLOSES), open_]))
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def count(self, event: int) -> np.ndarray:
        return self.per_doc((self.out & event) > 0)

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words a and b (numbers of equal length) have the same bytes."""
        length = self.ends[a] - self.starts[a]
        same = np.ones(len(a), bool)
        short = np.flatnonzero(length <= PROBED_BYTES)
        if len(short):
            at = {k: v[short] for k, v in (("a", self.starts[a]), ("b", self.starts[b]))}
            left = length[short]
            for k in range(0, int(left.max()), 8):
                more = np.flatnonzero((left > k) & same[short])
                unread = np.maximum(8 - (left[more] - k), 0).astype(np.uint64) * np.uint64(8)
                x = self._eights[at["a"][more] + k] ^ self._eights[at["b"][more] + k]
                same[short[more]] = (x << unread) == 0  # bytes after the word fall out
        for i in np.flatnonzero(length > PROBED_BYTES):
            x, y, n = self.starts[a[i]], self.starts[b[i]], length[i]
            same[i] = np.array_equal(self.data[x : x + n], self.data[y : y + n])
        return same

    def n_distinct(self) -> np.ndarray:
        """How many different words each text has."""
        n = len(self.starts)
        if not n:
            return np.zeros(len(self.offsets) - 1, np.int64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        self._eights = np.ndarray((len(self.data),), "<u8", padded, strides=(1,))
        hashed = mix(self.words() + self.doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        length = self.ends - self.starts
        slots = 1 << int(2 * n - 1).bit_length()
        held = np.full(slots, -1, np.int64)
        new = np.zeros(n, bool)
        waiting = np.arange(n)
        slot = (hashed & np.uint64(slots - 1)).astype(np.int64)
        while len(waiting):
            at = slot[waiting]
            free = held[at] < 0
            # of several words for one free slot the first takes it
            held[at[free][::-1]] = waiting[free][::-1]
            there = held[at]
            mine = there == waiting
            new[waiting[mine]] = True
            like = (
                ~mine
                & (self.doc[there] == self.doc[waiting])
                & (hashed[there] == hashed[waiting])
                & (length[there] == length[waiting])
            )
            maybe = np.flatnonzero(like)
            like[maybe] = self._equal(waiting[maybe], there[maybe])
            waiting = waiting[~mine & ~like]
            slot[waiting] = (slot[waiting] + 1) & (slots - 1)
        return np.bincount(self.doc[new], minlength=len(self.offsets) - 1)


def measures(texts: pa.Array) -> list[np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text."""
    out = [np.zeros(len(texts), np.int64) for _ in range(5)]
    for first, data, offsets in blocks(texts):
        run = Transduced(data, offsets)
        at = slice(first, first + len(offsets) - 1)
        for column, values in zip(
            out, (run.n_words, run.n_distinct(), run.count(CAPITAL), run.count(POINT), run.count(SYMBOL))
        ):
            column[at] = values
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        marks = [hashlib.sha256(t.as_buffer() or b"").digest() for t in binary(texts)]
        columns = [*measures(texts), pa.array(marks, pa.binary())]
        names = [p.split()[0] for p in MEASURES.split(", ")] + ["mark"]
        kept = {c: batch.column(c) for c in ("doc_id", "part")}
        yield pa.RecordBatch.from_arrays(
            [*kept.values(), *(pa.array(c) if isinstance(c, np.ndarray) else c for c in columns)],
            [*kept, *names],
        )


def measured(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, the measures, mark): one row per document, mark its text's SHA-256."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"doc_id {kind}, part string, {MEASURES}, mark binary")


def failure_sets(
    docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, part: str = "lang"
) -> DataFrame:
    """(part, failed, n, good, toxic): documents by the set of filters they fail.

    ``failed`` has bit k set for the k-th filter. At most 2 ** len(filters) rows a part.
    """
    bits = {name: 1 << k for k, name in enumerate(filters)}
    own = [F.when(F.expr(c), bits[k]).otherwise(0) for k, c in filters.items() if c != COPY]
    copy = sum(bits[k] for k, c in filters.items() if c == COPY)
    docs = measured(docs, part).select(
        "doc_id", "part", "mark", sum(own, F.lit(0)).cast("int").alias("failed")
    )
    known = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    text = ["mark", "part", "failed", "good", "toxic"]
    # rows are by doc_id after the join, so the first grouping moves nothing
    folded = (
        docs.join(known, "doc_id", "left")
        .na.fill(0, ["good", "toxic"])
        .groupBy("doc_id", *text)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*text)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        )
    )
    # a text has a row per part and labels here, however many copies there are
    lowest = F.min("first.doc_id").over(Window.partitionBy("mark"))
    kept = F.when(F.col("first.doc_id") == lowest, F.col("first.n")).otherwise(0)
    sets = F.array(
        F.struct("failed", F.col("originals").alias("n")),
        F.struct(
            F.col("failed").bitwiseOR(F.lit(copy)).alias("failed"), (F.col("n") - F.col("originals")).alias("n")
        ),
    )
    return (
        folded.withColumn("originals", F.col("unnamed") + kept)
        .select("part", "good", "toxic", F.explode(sets).alias("s"))
        .groupBy("part", F.col("s.failed").alias("failed"))
        .agg(
            F.sum("s.n").alias("n"),
            F.sum(F.col("s.n") * F.col("good")).alias("good"),
            F.sum(F.col("s.n") * F.col("toxic")).alias("toxic"),
        )
    )


def _orders(names: list[str]) -> str:
    """JSON of every step of every order, with the bits of its filter and of those before."""
    bit = {name: 1 << k for k, name in enumerate(names)}
    return json.dumps(
        [
            {"filter_order": "".join(order), "step": k + 1, "own": bit[name], "before": sum(bit[x] for x in order[:k])}
            for order in permutations(names)
            for k, name in enumerate(order)
        ]
    )


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, part: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step in it.

    Counts of documents: ``kept`` after the step, ``removed`` in it, ``redundant``
    (failing the step's filter but removed before), ``unique_fails`` (failing no other
    filter), ``good_lost`` and ``toxic_lost`` (of those removed here), and ``shapley``:
    what the filter removes summed over all orders. A document that fails k filters is
    removed by each of them in one k-th of the orders.
    """
    sets = failure_sets(docs, labels, filters, part)
    # at most 2 ** len(filters) cells a part
    cells = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    step = "array<struct<filter_order:string,step:int,own:int,before:int>>"
    steps = cells.select(
        "part", "cells", F.explode(F.from_json(F.lit(_orders(list(filters))), step)).alias("at")
    )
    own, before = F.col("at.own"), F.col("at.before")

    def total(condition, count="n"):
        weight = count if callable(count) else lambda c: c[count]
        return F.aggregate(
            F.filter("cells", condition), F.lit(0).cast("long"), lambda acc, c: acc + weight(c)
        )

    def fails(c, bits):
        return c["failed"].bitwiseAND(bits) != 0

    def removed(c):
        return fails(c, own) & ~fails(c, before)

    shares = factorial(len(filters))
    return steps.select(
        "part",
        "at.filter_order",
        "at.step",
        total(lambda c: ~fails(c, own.bitwiseOR(before))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c, own) & fails(c, before)).alias("redundant"),
        total(lambda c: c["failed"] == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(
            lambda c: fails(c, own),
            lambda c: c["n"] * (F.lit(shares) / F.bit_count(c["failed"])).cast("long"),
        ).alias("shapley"),
    )
