"""Quality classifier: a sparse ensemble of rules over text statistics.

A random forest is grown on labelled documents' statistics. Every path from a root to
a node is a rule, a conjunction of comparisons. A logistic regression with an L1
penalty weighs the rules, most of them with zero, and what remains is compiled into
one Spark column expression over the statistics.

Training looks at ``max_rows`` labelled documents at most, chosen by a hash of their
id; a fifth of the documents, by crc32 of the id, never takes part. Only the text
makes the score.

Defined cases: a null or empty text has statistics of zero and is scored like any
other; labels other than 0 and 1 are ignored, and of several labels of one document
the lowest counts; without labelled documents of both kinds the score is the smoothed
share of label 1; repeated rows each give a row; a null doc_id is held out of training.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.quality import CLASSES, base_counts, class_counts
from tidemark.llm.scan import Block, blocks
from tidemark.plans import durable

STATISTICS = (
    "log_words",
    "word_length",
    "words_a_line",
    "upper",
    "digits",
    "symbols",
    "points",
    "others",
    "wide",
    "bangs",
    "bars",
    "repeated_lines",
    "repeated_words",
    "doubled_words",
    "upper_lines",
    "pointless_lines",
)
FOLDS, HELD_OUT = 5, 0
MAX_ROWS = 40_000
TREES, DEPTH, PENALTY, SEED = 24, 4, 0.001, 20240229
THRESHOLD = 0.3

_STRUCT = "struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">"
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER | np.roll(_UPPER, 32)


def statistics_of(block: Block) -> np.ndarray:
    """The STATISTICS of each text, one row a text; shares are 0 where there is nothing."""
    n = len(block.offsets) - 1
    classes = dict(zip(CLASSES, class_counts(block).T))
    words, word_chars, symbols, dup_lines, repeat_words = base_counts(block)
    starts, _, line_doc = block.lines()
    lines = np.bincount(line_doc, minlength=n)
    chars = sum(classes.values())
    letters = classes["lower"] + classes["upper"]
    hashes = block.words()
    doubled = np.zeros(len(hashes), bool)
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (block.doc[1:] == block.doc[:-1])

    def share(a, b):
        return a / np.maximum(b, 1)

    def line_share(marks, of):
        """Share of lines where one byte mark is more than half as frequent as another."""
        ends = np.append(starts[1:], len(block.data))
        sums = [np.concatenate([[0], np.cumsum(m)]) for m in (marks, of)]
        a, b = (s[ends] - s[starts] for s in sums)
        return share(np.bincount(line_doc[2 * a > np.maximum(b, 1)], minlength=n), lines)

    # a line without a sentence's mark, by its words
    point = np.isin(block.data, list(b".,;:?"))
    word_start = np.zeros(len(block.data), bool)
    word_start[block.starts] = True
    sums = [np.concatenate([[0], np.cumsum(m)]) for m in (point, word_start)]
    ends = np.append(starts[1:], len(block.data))
    bare = (sums[0][ends] - sums[0][starts] == 0) & (sums[1][ends] - sums[1][starts] > 8)
    return np.column_stack(
        [
            np.log1p(words),
            share(word_chars, words),
            share(words, lines),
            share(classes["upper"], letters),
            share(classes["digit"], chars),
            share(symbols, chars),
            share(classes["point"], chars),
            share(classes["other"], chars),
            share(classes["wide"], chars),
            share(block.per_doc(block.data == 33), words),
            share(block.per_doc(block.data == 124), words),
            share(dup_lines, lines),
            share(repeat_words, words),
            share(np.bincount(block.doc[doubled], minlength=n), words),
            line_share(_UPPER[block.data], _LETTER[block.data]),
            share(np.bincount(line_doc[bare], minlength=n), lines),
        ]
    ).astype(float)


def _statistics(texts: pa.Array) -> pa.Array:
    parts = [statistics_of(Block(data, offsets)) for _, data, offsets in blocks(texts)]
    table = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
    return pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(c)) for c in table.T], list(STATISTICS)
    )


def statistics(text: Column) -> Column:
    return arrow_udf(_statistics, _STRUCT)(F.coalesce(text, F.lit("")).cast("binary"))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


Rule = tuple[tuple[int, str, float], ...]

_NODE = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-\d.Ee]+)\)")


def paths(tree: str) -> list[Rule]:
    """The rules of a tree from its printed form, without comparisons that others imply."""
    held: list[tuple[int, tuple[int, str, float]]] = []
    out = []
    for line in tree.splitlines():
        if not (m := _NODE.match(line)):
            continue
        depth = len(m[1])
        held = [h for h in held if h[0] < depth]
        held.append((depth, (int(m[3]), m[4], float(m[5]))))
        tight: dict[tuple[int, str], float] = {}
        for _, (k, sign, value) in held:
            tighter = min if sign == "<=" else max
            tight[k, sign] = tighter(value, tight.get((k, sign), value))
        out.append(tuple(sorted((k, s, v) for (k, s), v in tight.items())))
    return out


def compiled(rule: Rule) -> Column:
    """Whether a row of statistics meets a rule."""
    out = F.lit(True)
    for k, sign, value in rule:
        stat = F.col(STATISTICS[k])
        out = out & (stat <= value if sign == "<=" else stat > value)
    return out


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    base: float

    def score(self) -> Column:
        """Chance of label 1, from the columns STATISTICS."""
        total = F.lit(self.base)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(compiled(rule), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from (doc_id, STATISTICS) and (doc_id, quality).

    In place of the statistics, ``stats`` may have the ``text``: then only those of the
    chosen rows are computed.
    """
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("label")
    )
    usable = known.where(fold(F.col("doc_id")) != HELD_OUT).join(
        stats.select("doc_id"), "doc_id", "left_semi"
    )
    kinds = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    n = sum(kinds.values())
    if len(kinds) < 2:
        share = (kinds.get(1.0, 0) + 1) / (n + 2)
        return Model((), (), float(np.log(share / (1 - share))))
    part = 1 << 20
    chosen = usable.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(part)) < F.lit(min(part, part * max_rows // n))
    )
    # about max_rows at most, so they may go to all tasks; no text moves
    own = stats.join(F.broadcast(chosen), "doc_id")
    if "text" in stats.columns:
        own = own.select("label", statistics(F.col("text")).alias("s")).select("label", "s.*")
    # placed and ordered by their values, so that the model depends on them alone
    placed = own.select(*STATISTICS, "label").repartition(4, *STATISTICS, "label")
    rows = durable(placed.sortWithinPartitions(*STATISTICS, "label"))
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows).cache()
    forest = RandomForestClassifier(
        featuresCol="x",
        numTrees=TREES,
        maxDepth=DEPTH,
        subsamplingRate=0.7,
        featureSubsetStrategy="0.5",
        minInstancesPerNode=5,
        seed=SEED,
    ).fit(rows)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree.toDebugString)})
    if not rules:
        share = kinds[1.0] / n
        return Model((), (), float(np.log(share / (1 - share))))
    flags = F.array(*(compiled(r).cast("double") for r in rules))
    marked = rows.select("label", array_to_vector(flags).alias("r")).cache()
    fitted = LogisticRegression(
        featuresCol="r", elasticNetParam=1.0, regParam=PENALTY, maxIter=60
    ).fit(marked)
    marked.unpersist()
    rows.unpersist()
    weights = fitted.coefficients.toArray()
    used = np.flatnonzero(weights)
    return Model(
        tuple(rules[i] for i in used), tuple(float(weights[i]) for i in used), float(fitted.intercept)
    )


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    stats = durable(
        docs.select("doc_id", statistics(F.col("text")).alias("s")).select("doc_id", "s.*")
    )
    model = train(stats, labels, max_rows)
    return stats.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(True)).alias("held_out"),
        model.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without those predicted 0."""
    score = train(docs.select("doc_id", "text"), labels, max_rows).score()
    named = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("_row"),
        statistics(F.col("text")).alias("_stats"),
    )
    return named.select("_row", "_stats.*").where(score >= THRESHOLD).select("_row.*")
