"""Line dedup by overlapping windows of three lines.

The lines of a document are its \\n-split lines that hold a word; surrounding blanks
do not count. Every three consecutive lines are a window. Of each window found more
than once anywhere, all occurrences but the first (lowest doc_id, then position) are
covered, from their first line to their last with any blank ones between, and the
union of the covered positions is removed.

A window is known by two 64-bit hashes. Hashes are counted with partial sums and only
repeated windows are looked up again, so a passage that a third of all documents
share costs no more than its occurrences.

Defined cases: a null text stays null and has no lines; texts of fewer than three
lines have no window and stay as they are; a null doc_id comes before all others;
rows that share a doc_id are told apart by a hash of their text, and rows equal in
both count as one occurrence and get the same result. All other columns are kept; one
named n_lines_removed is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import durable

WIDTH = 3
BLANKS = " \t\v\f\r"


def _trimmed(line):
    return F.trim(line, F.lit(BLANKS))


def line_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, low, high, k1, k2): every window and the \\n-split lines it spans."""
    numbered = F.transform(
        F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), _trimmed(x).alias("x"))
    )
    # two independent hashes: the second starts from another value
    lines = F.transform(
        F.filter(numbered, lambda p: p["x"] != ""),
        lambda p: F.struct(
            p["i"].alias("i"),
            F.xxhash64(p["x"]).alias("a"),
            F.xxhash64(F.lit(7), p["x"]).alias("b"),
        ),
    )
    hashed = docs.select("doc_id", F.xxhash64("text").alias("mark"), lines.alias("h"))

    def window(k):
        at = [F.get("h", k + j) for j in range(width)]
        return F.struct(
            at[0]["i"].alias("low"),
            at[-1]["i"].alias("high"),
            F.xxhash64(*(x["a"] for x in at)).alias("k1"),
            F.xxhash64(*(x["b"] for x in at)).alias("k2"),
        )

    starts = F.sequence(F.lit(0), F.size("h") - width)
    return (
        hashed.where(F.size("h") >= width)
        .select("doc_id", "mark", F.explode(F.transform(starts, window)).alias("w"))
        .select("doc_id", "mark", "w.*")
    )


def covered_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, gone): the numbers of the lines to remove, where there are any."""
    windows = durable(line_windows(docs, width))
    place = F.struct("doc_id", "mark", "low")
    repeated = (
        windows.groupBy("k1", "k2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .drop("last")
    )
    later = windows.join(repeated, ["k1", "k2"]).where(~place.eqNullSafe(F.col("first")))
    spans = later.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("low", "high")).alias("s"))
    return spans.select(
        "doc_id",
        "mark",
        F.array_distinct(
            F.flatten(F.transform("s", lambda x: F.sequence(x["low"], x["high"])))
        ).alias("gone"),
    )


def without(text, gone):
    """The text without the \\n-split lines numbered in ``gone``."""
    lines = F.split(text, "\n", -1)
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone))
    return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")


def remove_repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with shortened texts, and ``n_lines_removed``."""
    gone = covered_lines(docs.select("doc_id", "text"), width)
    # the caller's row travels in a struct, so its columns may have any name
    held = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.xxhash64("text").alias("mark")
    )
    match = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.mark") == F.col("g.mark"))
    text, lost = F.col("d.row.text"), F.col("g.gone")
    cut = F.when(lost.isNull(), text).otherwise(without(text, lost))
    return (
        held.alias("d")
        .join(gone.alias("g"), match, "left")
        .select(
            *(
                (cut if c == "text" else F.col(f"d.row.`{c}`")).alias(c)
                for c in docs.columns
                if c != "n_lines_removed"
            ),
            F.coalesce(F.size(lost), F.lit(0)).alias("n_lines_removed"),
        )
    )
