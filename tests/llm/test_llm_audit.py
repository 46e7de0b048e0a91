"""The filter audit: its transducer, its hash table, and all orders by brute force."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import rows
from tests.llm.conftest import SCHEMA, prose
from tidemark.llm import audit

PARTS = [" ", " ", "\n", "\x0b", "\x0c", "\t", "a", "B", "Éa", "#", "$x", "語", "👍", "\x1c", "\xa0", "|", "Word", "\x00", "Aa"]


def strange(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measured(text):
    text = text or ""
    w = words_of(text)
    return (
        len(w), len(set(w)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))
    )


def test_measures_equal_patterns():
    long = " ".join(f"w{k % 700}" for k in range(300_000))  # more than one block
    texts = strange(3000) + [None, "", "x" * 2_000_000, long, "y" * 70 + " " + "y" * 70 + " " + "y" * 69 + "z", "end"]
    got = list(zip(*(c.tolist() for c in audit.measures(pa.array(texts)))))
    assert got == [measured(t) for t in texts]


def test_slices_of_arrays():
    texts = pa.array(strange(50, 8)).slice(10, 25)
    got = list(zip(*(c.tolist() for c in audit.measures(texts))))
    assert got == [measured(t) for t in texts.to_pylist()]


@pytest.mark.parametrize("hash_", [lambda x: x * np.uint64(0), lambda x: x % np.uint64(3)])
def test_colliding_hashes_do_not_merge_words(monkeypatch, hash_):
    """With no hash left to tell words apart, their bytes still do."""
    monkeypatch.setattr(audit, "mix", hash_)
    monkeypatch.setattr(audit.Transduced, "words", lambda self: self.starts.astype(np.uint64) * np.uint64(0))
    texts = ["ab ba ab aa", "ab", "aaaaaaaab aaaaaaaac aaaaaaaab aaaaaaaa", "x" * 80 + " " + "x" * 79 + "y " + "x" * 80]
    assert audit.measures(pa.array(texts))[1].tolist() == [3, 1, 3, 2]


def test_the_table_of_transitions():
    after, out = audit.transducer()
    assert sorted(np.flatnonzero(after == audit.BETWEEN)) == [9, 10, 11, 12, 13, 32]
    out = out.reshape(2, 256)
    assert out[audit.BETWEEN, ord("A")] == audit.OPENS | audit.POINT | audit.CAPITAL
    assert out[audit.INSIDE, ord(" ")] == audit.CLOSES | audit.POINT
    assert out[audit.INSIDE, 0x80] == 0 and out[audit.INSIDE, 0xE8] == audit.POINT
    assert out[audit.INSIDE, ord("|")] == audit.SYMBOL | audit.POINT


# ------------------------------------------------------------------ all orders


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failing = []
    for i, text, lang in docs:
        n, distinct, caps, points, symbols = measured(text)
        fails = {
            "A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * caps > 10 * points, "D": symbols > 0,
            "E": i is not None and i > least[text or ""],
        }
        failing.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {f[0] for f in failing}:
        own = [f for f in failing if f[0] == part]
        table, removed_by = [], Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                removed_by[x] += len(gone)
                fail = sum(x in f[1] for f in own)
                table.append(
                    (part, "".join(order), step, len(left), len(gone), fail - len(gone),
                     sum(f[1] == {x} for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone))
                )
        out += [(*t, removed_by[t[1][t[2] - 1]]) for t in table]
    return sorted(out)


def check(spark, docs, labels):
    rng = random.Random(1)
    other = (None, None, 1, "x", "x", "x", "x", 5, 0.5, 1, 2, 3, 4, 5, 6, "y")
    frame = spark.createDataFrame([(*d, *other) for d in docs], SCHEMA)
    marks = spark.createDataFrame([(*x, rng.random()) for x in labels], "doc_id bigint, quality int, toxic int, n double")
    got = sorted(tuple(r) for r in audit.audit(frame, marks).collect())
    assert got == brute(docs, labels)
    return got


def test_every_order_by_brute_force(spark):
    rng = random.Random(9)
    texts = [prose(k, 120) for k in range(4)] + strange(6, 2) + [" ".join(f"w{k}" for k in range(130)), None, "", "LOUD " * 120]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None])) for i in range(0, 170, 2)]
    got = check(spark, docs, labels)
    assert len(got) == 3 * 600
    assert all(sum(r[4] for r in got if r[:2] == (p, "ABCDE")) + next(
        r[3] for r in got if r[:3] == (p, "ABCDE", 5)) == sum((d[2] or "") == p for d in docs) for p in ("", "en", "de"))


def test_odd_rows(spark):
    text = prose(1, 130)
    docs = [(3, text, "en"), (3, text, "en"), (3, text, "de"), (2, text, "fr"), (2, text, "fr"), (None, text, "en"),
            (None, text, "en"), (5, None, None), (6, "", None), (7, " \n", "en")]
    labels = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (99, 1, 1)]
    check(spark, docs, labels)


def test_a_hot_text_and_no_documents(spark):
    docs = [(i, "same words again", "en") for i in range(3000)]
    check(spark, docs, [])
    check(spark, [], [(1, 1, 1)])


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b c", "en"), (2, "a #", "en"), (3, "a #", "en")], "doc_id int, text string, source string")
    labels = spark.createDataFrame([], "doc_id int, quality int, toxic int")
    got = rows(audit.audit(docs, labels, {"S": "n_symbols > 0", "X": audit.COPY}, part="source").orderBy("filter_order", "step"))
    assert [r[1:6] for r in got] == [("SX", 1, 1, 2, 0), ("SX", 2, 1, 0, 1), ("XS", 1, 2, 1, 0), ("XS", 2, 1, 1, 1)]
