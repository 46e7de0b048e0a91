"""Step funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import percent, round_to


def funnel(
    events: DataFrame,
    steps: list[str],
    unit: str = "session_id",
    step: str = "event_name",
) -> DataFrame:
    """Distinct units per step, with conversion against the first and previous step.

    A unit counts for a step whenever it has the event, in any order of time.
    ``pos`` ranks the steps that occur. Returns one row per occurring step.
    """
    reached = (
        events.where(F.col(step).isin(steps))
        .groupBy(step)
        .agg(F.countDistinct(unit).alias("sessions"))
    )
    # at most len(steps) rows from here on
    place = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(step))
    in_order = Window.orderBy("_place")
    return (
        reached.withColumn("_place", place)
        .select(
            step,
            "sessions",
            F.row_number().over(in_order).cast("long").alias("pos"),
            percent("sessions", F.first("sessions").over(in_order)).alias("overall_pct"),
            percent("sessions", F.lag("sessions").over(in_order)).alias("step_pct"),
        )
        .orderBy("pos")
    )


def funnel_drop(
    events: DataFrame,
    steps: list[str],
    unit: str = "session_id",
    step: str = "event_name",
) -> DataFrame:
    """The funnel with what each step loses, and which loss is worst.

    ``sharpest`` marks the largest relative drop, ``largest`` the largest
    absolute loss; the first of equal losses wins. ``loss_rank`` orders the
    steps by absolute loss.
    """
    in_order = Window.orderBy("pos")
    lost = funnel(events, steps, unit, step).select(
        step,
        "pos",
        "sessions",
        "overall_pct",
        "step_pct",
        round_to(F.lit(100.0) - F.col("step_pct"), 2).alias("step_drop_pct"),
        (F.lag("sessions").over(in_order) - F.col("sessions")).alias("sessions_lost"),
    )
    by_drop = Window.orderBy(F.col("step_drop_pct").desc_nulls_last(), "pos")
    by_loss = Window.orderBy(F.col("sessions_lost").desc_nulls_last(), "pos")
    known = F.col("sessions_lost").isNotNull()
    return (
        lost.withColumns(
            {
                "sharpest": (F.row_number().over(by_drop) == 1) & known,
                "largest": (F.row_number().over(by_loss) == 1) & known,
                "loss_rank": F.when(known, F.row_number().over(by_loss).cast("long")),
            }
        )
        .orderBy("pos")
    )


def loss_table(
    events: DataFrame,
    steps: list[str],
    unit: str = "session_id",
    step: str = "event_name",
) -> DataFrame:
    """One row per transition, largest absolute loss first."""
    return (
        funnel_drop(events, steps, unit, step)
        .where(F.col("loss_rank").isNotNull())
        .select("loss_rank", step, "sessions", "step_pct", "step_drop_pct", "sessions_lost")
        .orderBy("loss_rank")
    )
