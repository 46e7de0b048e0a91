"""Table summaries, segment metrics, weekly series and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    percent,
    round_to,
    total,
    week_ending_sunday,
)
from tidemark.plans import dense, exact_quantiles, value_counts


def dataset_summary(
    tables: dict[str, DataFrame], distinct: dict[str, tuple[DataFrame, str]] | None = None
) -> DataFrame:
    """Rows per table, and distinct values of chosen columns, one row each."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")
        for name, df in tables.items()
    ]
    rows += [
        df.agg(F.countDistinct(column).alias("n")).select(F.lit(name).alias("item"), "n")
        for name, (df, column) in (distinct or {}).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def metric_by_segment(df: DataFrame, metric: str, segment: str, money: bool = False) -> DataFrame:
    """Count, mean, sum, share of the total and distance from the overall mean
    per segment, and the gap between the largest and the smallest mean.

    The overall figures are one row added up from the segments' rows. Both readings of
    the segments share one shuffle, so the source is read once, and a segment column of
    any number of values stays distributed. ``money`` sums exact cents.
    """
    means = (
        df.where(F.col(metric).isNotNull())
        .groupBy(segment)
        .agg(F.count(F.lit(1)).alias("n"), total(metric, money).alias("total"))
        .withColumn("_mean", F.col("total") / F.col("n"))
    )
    overall = means.agg(
        F.struct(
            total("total").alias("total"),
            F.sum("n").alias("n"),
            (F.max("_mean") / F.nullif(F.min("_mean"), F.lit(0.0))).alias("gap"),
        )
    ).scalar()
    return (
        means.withColumn("_all", overall)
        .select(
            segment,
            "n",
            round_to("_mean", 4).alias("mean"),
            round_to("total", 2).alias("total"),
            percent("total", "_all.total", 1).alias("share_pct"),
            round_to(
                (F.col("_mean") / F.nullif(F.col("_all.total") / F.col("_all.n"), F.lit(0.0)) - 1.0)
                * 100.0,
                1,
            ).alias("vs_overall_pct"),
            round_to("_all.gap", 4).alias("gap"),
        )
        .orderBy(F.desc("total"), segment)
    )


def composition(df: DataFrame, row_dim: str, col_dim: str) -> DataFrame:
    """Share of each ``col_dim`` value within each ``row_dim`` value."""
    within = Window.partitionBy(row_dim)
    return (
        df.groupBy(row_dim, col_dim)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share_pct", percent("n", F.sum("n").over(within), 2))
        .orderBy(row_dim, col_dim)
    )


def weekly_series(
    df: DataFrame, ts: str, metric: str | None = None, money: bool = False
) -> DataFrame:
    """Week (ending Sunday), value and count for every week of the range; weeks
    without rows are zero. Without a metric the value is the count; ``money`` sums
    exact cents."""
    value = F.count(F.lit(1)).cast("double") if metric is None else total(metric, money)
    weeks = (
        df.where(F.col(ts).isNotNull())
        .groupBy(week_ending_sunday(ts).alias("week"))
        .agg(value.alias("value"), F.count(F.lit(1)).alias("n"))
    )
    return every_week(weeks)


def every_week(weeks: DataFrame) -> DataFrame:
    """(week, value, n) of weeks that have rows, with zeros for those between."""
    filled = dense(weeks, "week", "week")
    return filled.select(
        "week",
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def weekly_resample(orders: DataFrame, ts: str = "order_ts", measure: str = "amount") -> DataFrame:
    """Weekly revenue and orders, change against the week before, and the peak.

    The measure is money: cents are exact, whatever the partitioning."""
    by_week = Window.orderBy("week")  # one row per week
    by_size = Window.orderBy(F.desc("value"), "week")
    previous = F.lag("value").over(by_week)
    return (
        weekly_series(orders, ts, measure, money=True)
        .withColumns(
            {"_prev": previous, "is_peak": F.row_number().over(by_size) == 1}
        )
        .select(
            "week",
            round_to("value", 2).alias("revenue"),
            F.col("n").alias("orders"),
            round_to(
                (F.col("value") / F.nullif(F.col("_prev"), F.lit(0.0)) - 1.0) * 100.0, 1
            ).alias("jump_pct"),
            "is_peak",
        )
        .orderBy("week")
    )


def histogram(
    df: DataFrame, column: str, bins: int = 40, log10: bool = False
) -> DataFrame:
    """Equal-width histogram; the last bin includes the maximum, and bins
    without rows are listed with zero."""
    x = F.col(column).cast("double")
    values = df.select((F.log10(x) if log10 else x).alias("x")).where("x IS NOT NULL")
    bounds = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    limits = bounds.select(F.struct("lo", "hi")).scalar()
    width = F.nullif(F.col("_b.hi") - F.col("_b.lo"), F.lit(0.0))
    place = F.floor((F.col("x") - F.col("_b.lo")) / width * bins)
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("long")
    filled = (
        values.withColumn("_b", limits)
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = (F.col("hi") - F.col("lo")) / bins
    every = bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"),
        "lo",
        "hi",
    )
    return (
        every.join(filled, "bin", "left")
        .select(
            "bin",
            round_to(F.col("lo") + F.col("bin") * step, 4).alias("bin_from"),
            round_to(F.col("lo") + (F.col("bin") + 1) * step, 4).alias("bin_to"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def unbiased_skewness(column: str):
    """Sample skewness with the small-sample correction (NULL below 3 rows)."""
    count = F.count(column).cast("double")
    factor = F.sqrt(count * (count - 1.0)) / F.nullif(count - 2.0, F.lit(0.0))
    return F.when(count >= 3, F.skewness(column) * factor)


def distribution_shape(
    df: DataFrame, column: str, log10: bool = False, slices: int | None = None
) -> DataFrame:
    """Rows, mean, exact median and skewness of a column, or of its log10."""
    x = F.col(column).cast("double")
    values = df.select((F.log10(x) if log10 else x).alias("x")).where("x IS NOT NULL")
    median = exact_quantiles(
        value_counts(values, [], "x", slices), [], "x", {"median": 0.5}
    ).select("median")
    return values.agg(
        F.count("x").alias("n"),
        F.avg("x").alias("_mean"),
        unbiased_skewness("x").alias("_skew"),
    ).withColumn("_median", median.scalar()).select(
        "n",
        round_to("_mean", 4).alias("mean"),
        round_to("_median", 4).alias("median"),
        round_to("_skew", 4).alias("skew"),
    )
