"""Exact quantiles whose memory does not grow with the data.

Spark's ``percentile`` keeps every distinct value of a group in one task. For
amounts that is unbounded, so here:

1. equal values are counted first (map-side, so a value that fills a third of
   the table becomes one row per map task);
2. the counted values are range-partitioned by (group, value) and kept;
3. per-slice counts say which slice holds each wanted position;
4. only those slices are numbered, and only the wanted rows are picked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import durable
from tidemark.plans.joins import null_safe_join


def value_counts(
    df: DataFrame, by: list[str], column: str, slices: int | None = None
) -> DataFrame:
    """Counted non-null values, range-partitioned and kept: by, column, n, _slice."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [*by, column]
    ranged = (
        counted.repartitionByRange(slices, *order)
        if slices
        else counted.repartitionByRange(*order)
    )
    return durable(ranged.withColumn("_slice", F.spark_partition_id()))


def exact_quantiles(
    counts: DataFrame, by: list[str], column: str, probs: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles per group from :func:`value_counts`.

    Returns ``by``, ``n`` (non-null values) and one double column per entry of
    ``probs``.
    """
    per_slice = counts.groupBy(*by, "_slice").agg(F.sum("n").alias("_held"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    spans = per_slice.select(
        *by,
        "_slice",
        F.sum("_held").over(upto).alias("_end"),
        (F.sum("_held").over(upto) - F.col("_held")).alias("_start"),
        F.sum("_held").over(group).alias("n"),
    )

    def position(p: float):
        return (F.col("n") - 1).cast("double") * F.lit(p)

    wanted = F.array_distinct(
        F.flatten(
            F.array(
                *[
                    F.array(
                        F.floor(position(p)).cast("long"),
                        F.ceil(position(p)).cast("long"),
                    )
                    for p in probs.values()
                ]
            )
        )
    )
    # slices that hold a wanted position: at most two per group and probability
    targets = spans.select(
        *by,
        "_slice",
        "_start",
        F.col("n").alias("_rows"),
        F.filter(
            wanted, lambda p: (p >= F.col("_start")) & (p < F.col("_end"))
        ).alias("_positions"),
    ).where(F.size("_positions") > 0)

    # one row per slice at most, so it may be broadcast; the other slices are
    # dropped before anything is shuffled
    holding = F.broadcast(targets.select("_slice").distinct())
    numbered = null_safe_join(
        counts.join(holding, "_slice", "left_semi"), targets, [*by, "_slice"]
    )
    running = (
        Window.partitionBy(*by, "_slice")
        .orderBy(column)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = (
        numbered.withColumn("_last", F.col("_start") + F.sum("n").over(running))
        .withColumn("_first", F.col("_last") - F.col("n"))
        .select(
            *by,
            "_rows",
            F.explode(
                F.filter(
                    "_positions",
                    lambda p: (p >= F.col("_first")) & (p < F.col("_last")),
                )
            ).alias("_position"),
            F.col(column).cast("double").alias("_value"),
        )
    )
    # at most two values per probability
    found = picked.groupBy(*by).agg(
        F.max("_rows").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("_position", "_value"))).alias(
            "_at"
        ),
    )

    def interpolate(p: float):
        at = position(p)
        share = at - F.floor(at)
        low = F.col("_at")[F.floor(at).cast("long")]
        high = F.col("_at")[F.ceil(at).cast("long")]
        # equal ends need no arithmetic, which would turn infinity into NaN
        return F.when((share == 0.0) | (low == high), low).otherwise(
            low * (F.lit(1.0) - share) + high * share
        )

    for p in probs.values():
        if not 0.0 <= p <= 1.0 or math.isnan(p):
            raise ValueError(f"probability out of range: {p}")
    return found.select(
        *by, "n", *[interpolate(p).alias(name) for name, p in probs.items()]
    )
