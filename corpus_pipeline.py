"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, and all but the last return the columns of
``documents``. ``n_chars`` follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, packing, rules, secrets, setsketch
from tidemark.llm.queries import ship, table, vocabulary
from tidemark.plans import durable, release, written


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts 0 go."""
    ship(spark)
    return rules.reject_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line passages are cut out; documents left empty by it go."""
    cut = lines.remove_repeated_lines(docs)
    emptied = (F.col("n_lines_removed") > 0) & (F.trim(F.col("text"), F.lit(" \t\n\v\f\r")) == "")
    return _measured(cut.where(F.coalesce(~emptied, F.lit(True))), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, a similarity of 0.8 and more)
    the document with the smallest id stays.

    Rows that share a doc_id share its fate; rows with a null doc_id stay.
    """
    ship(spark)
    gone = setsketch.near_duplicates(docs, 80, width=5).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    ship(spark)
    return _measured(secrets.redact_secrets(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens go: one row a piece."""
    ship(spark)
    return packing.best_fit_packing(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", redaction),
    ("best-fit packing", packed),
]

# model training and packing are not SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it.

    Once a stage is written, the tables that went into it are deleted.
    """
    docs = table(spark, sf_dir, "documents")
    kept = set(written())  # tables of others
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs)
            *inner, _ = (path for path in written() if path not in kept)
            release(spark, *inner) if inner else None
    return docs
