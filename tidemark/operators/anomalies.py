"""Robust anomaly detection on a dated series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import round_to

# Fixed value: 0.75 quantile of the standard normal, which scales a median
# absolute deviation to a standard deviation.
MAD_SCALE = 0.6745


def mad_anomalies(
    series: DataFrame,
    at: str = "d",
    value: str = "revenue",
    history: int = 14,
    min_history: int = 7,
    threshold: float = 3.0,
    by: list[str] | None = None,
) -> DataFrame:
    """Modified z-score of each row against its preceding ``history`` rows.

    The baseline is the median of the prior rows; the spread is the median over
    the prior rows of their distance from *their own* baseline. Rows with too
    little history are dropped, and a zero spread gives no score. The series
    has one row per date, so its window is small; ``by`` names the columns of
    separate series.
    """
    by = by or []
    prior = Window.partitionBy(*by).orderBy(at).rowsBetween(-history, -1)
    x = F.col(value).cast("double")
    z = (
        F.lit(MAD_SCALE)
        * (F.col("_x") - F.col("_base"))
        / F.nullif(F.col("_mad"), F.lit(0.0))
    )
    return (
        series.withColumn("_x", x)
        .withColumns(
            {
                "_base": F.percentile("_x", 0.5).over(prior),
                "_seen": F.count("_x").over(prior),
            }
        )
        .withColumn("_off", F.abs(F.col("_x") - F.col("_base")))
        .withColumn("_mad", F.percentile("_off", 0.5).over(prior))
        .where(F.col("_seen") >= min_history)
        .select(
            *by,
            at,
            round_to("_x", 2).alias("daily_revenue"),
            round_to("_base", 2).alias("baseline_median"),
            round_to(z, 2).alias("z_mad"),
            F.when(F.abs(z) >= threshold, "YES").otherwise("").alias("anomalous"),
        )
        .orderBy(*by, at)
    )
