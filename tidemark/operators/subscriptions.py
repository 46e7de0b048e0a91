"""Recurring revenue, churn and plan summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    as_double,
    month_of,
    percent,
    round_to,
    total_money,
    units,
)
from tidemark.plans import date_series, dense, running_level


# an annual plan is worth a twelfth of its price a month: counting in twelfths of a
# cent keeps every sum whole, and the division comes last
TWELFTHS = 1200.0


def monthly_twelfths(plan: str = "plan", amount: str = "amount") -> Column:
    """What a subscription is worth per month, in twelfths of a cent."""
    cents = units(amount).cast("decimal(20,0)")
    return F.when(F.col(plan) == "annual", cents).otherwise(cents * 12).cast("decimal(22,0)")


def mrr(
    subs: DataFrame,
    end_month: str,
    started: str = "started_at",
    plan: str = "plan",
    amount: str = "amount",
) -> DataFrame:
    """Monthly recurring revenue and active subscriptions through ``end_month``.

    A subscription bills every month from its start; cancellations are not
    applied. Since nothing ends, the level is the running sum of the starts and
    no subscription is expanded into months. A start after ``end_month`` bills
    its own month only.
    """
    end = F.lit(end_month).cast("date")
    starts = subs.groupBy(month_of(started).alias("month")).agg(
        F.sum(monthly_twelfths(plan, amount)).alias("mrr"),
        F.count(F.lit(1)).alias("active_subs"),
    )
    upto_end = dense(starts, "month", "month", until=end_month).select(
        "month",
        F.coalesce("mrr", F.lit(0).cast("decimal(38,0)")).alias("mrr"),
        F.coalesce("active_subs", F.lit(0)).alias("active_subs"),
    )
    levels = upto_end.select("month", *running_level("month", "mrr", "active_subs"))
    late = starts.where(F.col("month") > end)
    return (
        levels.unionByName(late)
        .select(
            "month", round_to(as_double("mrr") / TWELFTHS, 2).alias("mrr"), "active_subs"
        )
        .orderBy("month")
    )


def churn(
    subs: DataFrame,
    cancels: DataFrame,
    start_month: str,
    end_month: str,
    sub_id: str = "sub_id",
    started: str = "started_at",
    cancelled: str = "cancelled_at",
    plan: str = "plan",
    amount: str = "amount",
) -> DataFrame:
    """Logo and MRR churn for each month of the range.

    A subscription is there at the start of the months after its start month,
    up to and including the month it is cancelled in. Each one becomes at most
    three marks (joins, leaves, churns); levels are running sums over months.
    One cancelled in its start month never reaches a month's start.
    """
    life = (
        subs.select(
            sub_id,
            month_of(started).alias("start_m"),
            monthly_twelfths(plan, amount).alias("mrr"),
        )
        .join(
            # the first of several cancellations counts
            cancels.groupBy(sub_id).agg(F.min(month_of(cancelled)).alias("cancel_m")),
            sub_id,
            "left",
        )
        .where("cancel_m IS NULL OR cancel_m > start_m")
    )

    def mark(month: Column, level: int, churned: int) -> Column:
        return F.struct(
            month.alias("m"), F.lit(level).alias("level"), F.lit(churned).alias("churned"), "mrr"
        )

    marks = life.select(
        F.inline(
            F.array(
                mark(F.add_months("start_m", 1), 1, 0),
                mark(F.add_months("cancel_m", 1), -1, 0),
                mark(F.col("cancel_m"), 0, 1),
            )
        )
    ).where("m IS NOT NULL")
    zero = F.lit(0).cast("decimal(38,0)")
    by_month = marks.groupBy("m").agg(
        F.sum("level").alias("subs_at_start"),
        F.sum(F.col("level") * F.col("mrr")).cast("decimal(38,0)").alias("mrr_at_start"),
        F.sum("churned").alias("churned"),
        F.sum(F.col("churned") * F.col("mrr")).cast("decimal(38,0)").alias("mrr_churned"),
    )
    wanted = date_series(subs.sparkSession, start_month, end_month, "month", "m")
    months = (
        wanted.withColumn("asked", F.lit(True))
        .join(by_month, "m", "full")
        .select(
            "m",
            "asked",
            F.coalesce("subs_at_start", F.lit(0)).alias("subs_at_start"),
            F.coalesce("mrr_at_start", zero).alias("mrr_at_start"),
            F.coalesce("churned", F.lit(0)).alias("churned"),
            F.coalesce("mrr_churned", zero).alias("mrr_churned"),
        )
    )
    levels = months.select(
        "m", "asked", "churned", "mrr_churned",
        *running_level("m", "subs_at_start", "mrr_at_start"),
    ).where("asked")
    # no subscriptions: the sums are empty, not zero
    at_start = F.when(F.col("subs_at_start") > 0, F.col("mrr_at_start"))
    left = F.when(F.col("churned") > 0, F.col("mrr_churned"))
    return levels.select(
        "m",
        "subs_at_start",
        "churned",
        percent("churned", "subs_at_start", 2).alias("logo_churn_pct"),
        round_to(as_double(at_start) / TWELFTHS, 2).alias("mrr_at_start"),
        round_to(as_double(left) / TWELFTHS, 2).alias("mrr_churned"),
        percent(left, at_start, 2).alias("mrr_churn_pct"),
    ).orderBy("m")


def plan_summary(
    subs: DataFrame,
    cancels: DataFrame,
    sub_id: str = "sub_id",
    plan: str = "plan",
    amount: str = "amount",
) -> DataFrame:
    """Subscriptions, revenue, mean price and cancellations per plan."""
    gone = cancels.select(sub_id).distinct().withColumn("_gone", F.lit(1))
    subscriptions = F.count(F.lit(1))
    total = as_double(total_money(amount))
    return (
        subs.join(gone, sub_id, "left")
        .groupBy(plan)
        .agg(
            subscriptions.alias("subs"),
            round_to(total, 2).alias("amount_sum"),
            round_to(total / subscriptions, 4).alias("amount_mean"),
            F.count("_gone").alias("cancelled"),
            percent(F.count("_gone"), subscriptions, 2).alias("cancelled_pct"),
        )
        .orderBy(plan)
    )
