"""Data tests. Each returns its findings as a DataFrame; a table without
violations gives an empty one (or a row whose status is PASS)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans import null_safe_join


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def unique_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once. Columns are compared as they are,
    so ('1','23') and ('12','3') differ and NULLs are values."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent row, with the number of child rows; NULL
    keys are not checked. Keys are counted before they are joined."""
    keys = (
        child.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return keys.join(parent.select(key), key, "left_anti")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their count; NULLs are not checked."""
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def monotonic(
    df: DataFrame, order: str, value: str, label: str, by: list[str] | None = None
) -> DataFrame:
    """Adjacent rows of a small ordered table, or of each group ``by``, whose value
    does not fall."""
    by = by or []
    following = F.lead(value).over(Window.partitionBy(*by).orderBy(order))
    return (
        df.withColumn("_next", following)
        .where(F.col("_next") >= F.col(value))
        .select(*by, label, value, F.col("_next").alias(f"next_{value}"))
    )


def assert_golden(df: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that differ or are missing: key, column, expected, actual."""
    columns = [c for c in expected.columns if c not in keys]
    actual = df.select(
        *keys, *[F.col(c).alias(f"_actual_{c}") for c in columns], F.lit(True).alias("_found")
    )
    both = null_safe_join(expected, actual, keys, "left")
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).cast("double").alias("expected"),
                F.col(f"_actual_{c}").cast("double").alias("actual"),
            )
            for c in columns
        ]
    )
    return (
        both.select(*keys, F.col("_found"), F.inline(pairs))
        .where(
            F.col("_found").isNull() | ~F.col("expected").eqNullSafe(F.col("actual"))
        )
        .drop("_found")
    )


def range_check(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Validity of columns against (low, high), both inclusive; None is open.

    All columns are counted in one pass. Returns one row per column.
    """
    counts = []
    for column, (low, high) in ranges.items():
        value = F.col(column)
        below = F.lit(False) if low is None else value < F.lit(low)
        above = F.lit(False) if high is None else value > F.lit(high)
        counts.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.count(value).alias("checked"),
                F.count_if(below).alias("below"),
                F.count_if(above).alias("above"),
            )
        )
    violations = F.col("below") + F.col("above")
    return (
        df.agg(F.array(*counts).alias("checks"))
        .select(F.inline("checks"))
        .withColumn("violations", violations)
        .withColumn("status", F.when(violations == 0, "PASS").otherwise("FAIL"))
    )


def equal_totals(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """A reconciliation: two one-value frames must agree to the cent."""
    return _reconciled(name, left, right, lambda a, b: F.abs(a - b) < 0.005)


def at_most(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """A reconciliation: the first one-value frame must not exceed the second."""
    return _reconciled(name, left, right, lambda a, b: a <= b)


def _reconciled(name: str, left: DataFrame, right: DataFrame, holds) -> DataFrame:
    a, b = F.col("left_value"), F.col("right_value")
    return (
        left.toDF("only")
        .select(F.col("only").cast("double").alias("left_value"))
        .withColumn("right_value", right.scalar().cast("double"))
        .select(
            F.lit(name).alias("check_name"),
            "left_value",
            "right_value",
            F.when(holds(a, b), "PASS").otherwise("FAIL").alias("status"),
        )
    )


def reconcile(checks: list[DataFrame]) -> DataFrame:
    """All reconciliations in one frame."""
    return reduce(lambda a, b: a.unionByName(b), checks)


def claim_check(claims: DataFrame, metrics: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Published numbers (metric, published) against recomputed ones (metric,
    value): REPRODUCED, MISMATCH, or NOT-CHECKABLE without a recomputed one."""
    gap = F.abs(F.col("published") - F.col("value"))
    verdict = (
        F.when(F.col("value").isNull() | F.col("published").isNull(), "NOT-CHECKABLE")
        .when(gap <= tolerance, "REPRODUCED")
        .otherwise("MISMATCH")
    )
    return (
        claims.select("metric", F.col("published").cast("double").alias("published"))
        .join(
            metrics.select("metric", F.col("value").cast("double").alias("value")),
            "metric",
            "left",
        )
        .select("metric", "published", "value", verdict.alias("verdict"))
    )


def late_parents(
    parent: DataFrame, child: DataFrame, key: str, earlier: str, later: str
) -> DataFrame:
    """One number: child rows dated before their parent (``later`` < ``earlier``).

    Child rows are counted per key and day before the join, so a parent with a
    third of all children does not fan out.
    """
    per_day = child.groupBy(key, F.to_date(later).alias("_later")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return (
        per_day.join(parent.select(key, F.to_date(earlier).alias("_earlier")), key)
        .where(F.col("_earlier") > F.col("_later"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
    )
