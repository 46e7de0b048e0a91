"""Exact global ranks without a single-task window.

``row_number() over (order by ...)`` moves every row to one task. Here the rows
are range-partitioned on the total order (Spark samples the borders, so a value
shared by a third of the rows is split as long as the order ends in a unique
key), numbered inside their partition, and shifted by the number of rows in the
partitions before. Only that partition-size table, one row per partition, is
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import durable

# monotonically_increasing_id() is (partition index << 33) + index in partition
_INDEX_BITS = 33
_INDEX_MASK = (1 << _INDEX_BITS) - 1


def global_rank(
    df: DataFrame,
    order: list,
    rank: str = "rank",
    rows: str = "rows",
    slices: int | None = None,
) -> DataFrame:
    """Add the 0-based ``rank`` of each row in ``order`` and the row count.

    ``order`` must end in a unique key, or the rank of tied rows is arbitrary.
    ``slices`` fixes the number of range partitions; by default adaptive
    execution sizes them.
    """
    ranged = (
        df.repartitionByRange(slices, *order)
        if slices
        else df.repartitionByRange(*order)
    )
    placed = durable(
        ranged.sortWithinPartitions(*order).withColumn(
            "_place", F.monotonically_increasing_id()
        )
    ).withColumn("_slice", F.shiftright("_place", _INDEX_BITS))

    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    in_order = Window.orderBy("_slice")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias(rows),
    )
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(
            rank, F.col("_before") + F.col("_place").bitwiseAND(F.lit(_INDEX_MASK))
        )
        .drop("_slice", "_place", "_before")
    )
