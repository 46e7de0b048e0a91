"""Calendars: bounded date series and gap-free versions of a dated frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STEPS = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAY",
    "month": "INTERVAL 1 MONTH",
}


def date_series(
    spark: SparkSession, start: str, end: str, grain: str, name: str = "d"
) -> DataFrame:
    """Dates from ``start`` to ``end`` inclusive, one row each."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    series = F.sequence(first, last, F.expr(STEPS[grain]))
    return spark.range(1).select(F.explode(series).alias(name))


def dense(df: DataFrame, column: str, grain: str, until=None) -> DataFrame:
    """``df`` (one row per period) with a row for every period in its range.

    ``until`` extends or cuts the calendar; rows of ``df`` outside it are kept
    by the caller. ``df`` is read once: gaps are filled from each row to the next.
    """
    in_order = Window.orderBy(column)  # one row per period
    step = F.expr(STEPS[grain])
    after = F.lead(column).over(in_order)
    if until is not None:
        end = F.lit(until).cast("date")
        df = df.where(F.col(column) <= end)
        after = F.coalesce(after, end + step)
    before_next = (after - step).cast("date")
    # a period stands for itself and for the empty ones up to the next
    own = F.sequence(F.col(column), F.coalesce(before_next, F.col(column)), step)
    rows = df.withColumn("_from", F.col(column)).withColumn("_own", own)
    others = [c for c in df.columns if c != column]
    return rows.withColumn(column, F.explode("_own")).select(
        column, *(F.when(F.col(column) == F.col("_from"), F.col(c)).alias(c) for c in others)
    )
