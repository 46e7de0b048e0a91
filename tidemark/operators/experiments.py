"""Two-arm comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import percent, round_to, two_sided_p_value

# Accepted spellings and outcomes of the application log.
TRUE_WORDS = ["true", "1", "yes", "y"]
HIT_OUTCOMES = ["screen", "interview", "offer"]


def conversion_counts(
    users: DataFrame,
    conversions: DataFrame,
    by: str = "ab_variant",
    user: str = "user_id",
) -> DataFrame:
    """Users and converters per group. Converters are made distinct before the
    join, so a heavy buyer does not fan it out."""
    converters = conversions.select(user).distinct().withColumn("_hit", F.lit(1))
    return (
        users.select(user, by)
        .join(converters, user, "left")
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("users"), F.count("_hit").alias("purchasers"))
    )


def _with_z(counts: DataFrame, variant: str, control: str, treatment: str) -> DataFrame:
    """Pooled two-proportion z-score, attached to the rows of both arms."""
    both = Window.partitionBy()  # one row per variant

    def of(arm: str, column: str):
        return F.max(F.when(F.col(variant) == arm, F.col(column))).over(both)

    n1, k1 = of(treatment, "users"), of(treatment, "purchasers")
    n0, k0 = of(control, "users"), of(control, "purchasers")
    pooled = (k1 + k0) / (n1 + n0)
    error = F.sqrt(pooled * (1.0 - pooled) * (1.0 / n1 + 1.0 / n0))
    z = (k1 / n1 - k0 / n0) / F.nullif(error, F.lit(0.0))
    return counts.withColumns(
        {"p1": k1 / n1, "p0": k0 / n0, "n1": n1, "n0": n0, "z": z}
    )


def ab_test(
    users: DataFrame,
    conversions: DataFrame,
    variant: str = "ab_variant",
    control: str = "control",
    treatment: str = "treatment",
    alpha: float = 0.05,
    user: str = "user_id",
) -> DataFrame:
    """Conversion per variant with a two-proportion z-test.

    ``lift_pp`` compares each variant with the previous one by name.
    """
    counts = conversion_counts(users, conversions, variant, user)
    return z_test(counts, variant, control, treatment, alpha)


def z_test(
    counts: DataFrame,
    variant: str = "ab_variant",
    control: str = "control",
    treatment: str = "treatment",
    alpha: float = 0.05,
) -> DataFrame:
    """The test on ready counts (variant, users, purchasers)."""
    rate = percent("purchasers", "users", None)
    by_name = Window.orderBy(variant)
    p_value = two_sided_p_value(F.col("z"))
    return (
        _with_z(counts, variant, control, treatment)
        .withColumn("_rate", rate)
        .select(
            variant,
            "users",
            "purchasers",
            round_to("_rate", 2).alias("conv_pct"),
            round_to(F.col("_rate") - F.lag("_rate").over(by_name), 2).alias("lift_pp"),
            round_to("z", 2).alias("z_score"),
            round_to(p_value, 6).alias("p_value"),
            F.when(p_value < alpha, "YES").otherwise("no").alias("significant_005"),
        )
        .orderBy(variant)
    )


def ab_rates(
    users: DataFrame,
    conversions: DataFrame,
    variant: str = "ab_variant",
    control: str = "control",
    treatment: str = "treatment",
    user: str = "user_id",
) -> DataFrame:
    """Rates, z-score and arm sizes in one row, without a p-value."""
    counts = conversion_counts(users, conversions, variant, user)
    return (
        _with_z(counts, variant, control, treatment)
        .where(F.col(variant) == control)
        .select(
            round_to(F.col("p0") * 100.0, 2).alias("control_pct"),
            round_to(F.col("p1") * 100.0, 2).alias("treatment_pct"),
            round_to("z", 2).alias("z"),
            "n0",
            "n1",
        )
    )


def segment_conversion(
    users: DataFrame, conversions: DataFrame, dim: str, user: str = "user_id"
) -> DataFrame:
    """Conversion per value of a user dimension, against the overall rate, with
    the ratio of the best to the worst value."""
    rates = conversion_counts(users, conversions, dim, user).withColumn(
        "_rate", F.col("purchasers") / F.col("users") * 100.0
    )
    # a scalar subquery, so that the values of a wide dimension stay spread out
    whole = rates.agg(
        F.struct(
            (F.sum("purchasers") / F.sum("users") * 100.0).alias("rate"),
            F.max("_rate").alias("best"),
            F.min("_rate").alias("worst"),
        )
    ).scalar()
    return (
        rates.withColumn("_all", whole)
        .select(
            dim,
            "users",
            F.col("purchasers").alias("buyers"),
            round_to("_rate", 2).alias("conv_pct"),
            round_to("_all.rate", 2).alias("overall_pct"),
            round_to(
                (F.col("_rate") / F.nullif(F.col("_all.rate"), F.lit(0.0)) - 1.0) * 100.0,
                1,
            ).alias("vs_overall_pct"),
            round_to(
                F.col("_all.best") / F.nullif(F.col("_all.worst"), F.lit(0.0)), 2
            ).alias("top_bottom_ratio"),
        )
        .orderBy(F.desc("conv_pct"), dim)
    )


def outcome_lift(
    log: DataFrame,
    arm: str = "link_used",
    outcome: str = "outcome",
    hits: list[str] | None = None,
    strong_lift: float = 0.20,
) -> DataFrame:
    """Hit rate with and without the arm flag over resolved rows, in one row.

    All inputs are text; a blank outcome is still pending and left out. Lift is
    NULL when an arm is empty or the base rate is zero. ``verdict`` follows the
    sign of the lift, ``strong`` the documented +20 percent rule.
    """
    hits = hits or HIT_OUTCOMES
    on = F.lower(F.trim(F.coalesce(arm, F.lit("")))).isin(TRUE_WORDS)
    result = F.lower(F.trim(F.coalesce(outcome, F.lit(""))))
    resolved = log.select(on.alias("on"), result.alias("result")).where("result <> ''")
    hit = F.col("result").isin(hits)
    counts = resolved.agg(
        F.count_if("on").alias("n_with"),
        F.count_if(F.col("on") & hit).alias("hits_with"),
        F.count_if(~F.col("on")).alias("n_without"),
        F.count_if(~F.col("on") & hit).alias("hits_without"),
    )
    rated = counts.withColumns(
        {
            "r1": F.col("hits_with") / F.nullif(F.col("n_with"), F.lit(0)),
            "r0": F.col("hits_without") / F.nullif(F.col("n_without"), F.lit(0)),
        }
    )
    gap = F.when(F.col("r0") > 0, F.col("r1") - F.col("r0"))
    relative = gap / F.nullif(F.col("r0"), F.lit(0.0))
    return rated.select(
        "n_with",
        round_to(F.col("r1") * 100.0, 1).alias("rate_with_pct"),
        "n_without",
        round_to(F.col("r0") * 100.0, 1).alias("rate_without_pct"),
        round_to(gap * 100.0, 1).alias("lift_pp"),
        round_to(relative * 100.0, 0).alias("lift_rel_pct"),
        F.when(relative.isNull(), "undefined")
        .when(relative >= 0, "positive")
        .otherwise("negative")
        .alias("verdict"),
        (relative >= strong_lift).alias("strong"),
    )
