import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id bigint, s string, row string, ids string, tree string, n_lines_removed bigint, score double, "
    "_mark bigint, _doc bigint, _gone bigint, _mark_of bigint, _done bigint, mark bigint, gone string"
)
WORDS = "the of a river stone walks under bright cold morning lamp seven letters read quietly".split()


def prose(seed, n=80):
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "", "s", "ing", ",", "."]) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + 10]) for k in range(0, n, 10))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    long = " ".join(f"w{k % 5000}" for k in range(150_000))
    texts = [
        (1, prose(1)),
        (2, prose(1)),
        (3, prose(2).replace("stone", "sténe")),
        (4, None),
        (5, ""),
        (6, " \n\t \n"),
        (7, "one"),
        (8, "two words"),
        (9, long),
        (9, long),
        (9, "another text of the same id"),
        (None, prose(1)),
        (None, None),
        (10, "ONE"),
        (11, prose(3) + " password = 'abcdefghijkl12' AKIA" + "Z9" * 10 + " deadbeefdeadbeef00"),
        (12, "\n".join(["same line here"] * 9)),
    ]
    rows = [
        (i, t, lang, None, None, 77, "x", "x", "x", "x", 5, 0.5, 1, 2, 3, 4, 5, 6, "y")
        for (i, t), lang in zip(texts, ["en", None, "xx-weird", "de"] * 4)
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture
def texts_of(spark):
    def build(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return build
