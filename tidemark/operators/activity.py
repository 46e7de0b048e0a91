"""Daily activity: DAU, MAU, stickiness, streaks, lifecycle states."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import day, percent, round_to, week_of
from tidemark.plans import running_level


def _active(events: DataFrame, period, user: str, name: str) -> DataFrame:
    """Periods in which users were active; anonymous and undated events are none."""
    return (
        events.select(F.col(user).alias("user_id"), period.alias(name))
        .where(F.col("user_id").isNotNull() & F.col(name).isNotNull())
        .distinct()
    )


def stickiness(
    events: DataFrame,
    window_days: int = 28,
    user: str = "user_id",
    ts: str = "event_time",
) -> DataFrame:
    """DAU, trailing-window MAU and their ratio for every day with activity.

    MAU is an interval sweep: a user active on day d counts on the days from d
    until the window ends or the user's next active day, whichever is earlier,
    so each (user, day) is one +1 and one -1 instead of a join with 28 days.
    Anonymous events count for no user, but their day is listed; events without
    a time are left out.
    """
    per_user = Window.partitionBy("user_id").orderBy("d")
    # distinct rows: the anonymous ones are one a day and so a short window
    covered = (
        events.select(F.col(user).alias("user_id"), day(ts).alias("d"))
        .where("d IS NOT NULL")
        .distinct()
        .select(
            "d",
            F.col("user_id").isNotNull().cast("int").alias("known"),
            F.least(F.date_add("d", window_days), F.lead("d").over(per_user)).alias("end"),
        )
    )
    marks = covered.select(
        F.inline(
            F.array(
                F.struct("d", F.col("known").alias("change"), F.lit(True).alias("seen")),
                F.struct(
                    F.col("end").alias("d"),
                    (-F.col("known")).alias("change"),
                    F.lit(False).alias("seen"),
                ),
            )
        )
    )
    by_day = marks.groupBy("d").agg(
        F.count_if(F.col("change") == 1).alias("dau"),
        F.sum("change").alias("mau"),
        F.bool_or("seen").alias("seen"),
    )
    return (
        by_day.select("d", "dau", "seen", *running_level("d", "mau"))
        .where("seen")
        .select("d", "dau", "mau", percent("dau", "mau").alias("stickiness_pct"))
        .orderBy("d")
    )


def mask_warmup(sticky: DataFrame, days: int = 28) -> DataFrame:
    """Stickiness with the first ``days`` days, whose window is incomplete, NULL."""
    first = F.min("d").over(Window.partitionBy())  # one row per day
    return sticky.withColumn("_first", first).select(
        "d",
        "dau",
        "mau",
        F.when(F.col("d") >= F.date_add("_first", days), F.col("stickiness_pct")).alias(
            "stickiness_pct"
        ),
    )


def daily_users(
    events: DataFrame, user: str = "user_id", ts: str = "event_time"
) -> DataFrame:
    """Distinct users of every day with an event; anonymous ones are not users."""
    return (
        events.select(F.col(user), day(ts).alias("d"))
        .where("d IS NOT NULL")
        .groupBy("d")
        .agg(F.countDistinct(user).alias("dau"))
    )


def moving_average(
    series: DataFrame,
    at: str = "d",
    value: str = "dau",
    rows: int = 7,
    name: str = "dau_ma7",
    digits: int = 1,
    by: list[str] | None = None,
) -> DataFrame:
    """Trailing mean over the last ``rows`` rows (shorter at the start) of a
    series that has one row per date, or per date of each group ``by``."""
    by = by or []
    trailing = Window.partitionBy(*by).orderBy(at).rowsBetween(-(rows - 1), Window.currentRow)
    return series.select(
        *by, at, value, round_to(F.avg(value).over(trailing), digits).alias(name)
    ).orderBy(*by, at)


def longest_streak(
    events: DataFrame,
    limit: int | None = 50,
    user: str = "user_id",
    ts: str = "event_time",
) -> DataFrame:
    """Longest run of consecutive active days per user, longest first.

    Consecutive days share the value "day minus row number". ``limit`` is the
    size of the leader board; None returns all users.
    """
    active = _active(events, day(ts), user, "d")
    per_user = Window.partitionBy("user_id").orderBy("d")
    runs = (
        active.withColumn("island", F.date_sub("d", F.row_number().over(per_user)))
        .groupBy("user_id", "island")
        .agg(F.count(F.lit(1)).alias("streak"))
        .groupBy("user_id")
        .agg(F.max("streak").alias("longest_streak_days"))
        .orderBy(F.desc("longest_streak_days"), "user_id")
    )
    return runs if limit is None else runs.limit(limit)


def lifecycle(
    events: DataFrame, user: str = "user_id", ts: str = "event_time"
) -> DataFrame:
    """Weekly new, returning, resurrecting and dormant users.

    A user-week without activity in the following week is one dormant mark on
    that following week; it shows only if somebody is active then. Active and
    dormant marks are counted in a single aggregation. Anonymous and undated
    events are left out.
    """
    per_user = Window.partitionBy("user_id").orderBy("wk")
    seen = _active(events, week_of(ts), user, "wk").select(
        "wk",
        F.lag("wk").over(per_user).alias("prev"),
        F.date_add("wk", 7).alias("after"),
        F.lead("wk").over(per_user).alias("next"),
    )
    state = (
        F.when(F.col("prev").isNull(), "new")
        .when(F.date_add("prev", 7) == F.col("wk"), "returning")
        .otherwise("resurrecting")
    )
    gone = ~F.col("next").eqNullSafe(F.col("after"))
    marks = seen.select(
        F.explode(
            F.array(
                F.struct(F.col("wk"), state.alias("state")),
                F.when(
                    gone,
                    F.struct(F.col("after").alias("wk"), F.lit("dormant").alias("state")),
                ),
            )
        ).alias("mark")
    ).where("mark IS NOT NULL")
    states = ("new", "returning", "resurrecting", "dormant")
    weeks = (
        marks.groupBy("mark.wk")
        .agg(*[F.count_if(F.col("mark.state") == s).alias(f"{s}_users") for s in states])
        .withColumn(
            "active_users",
            F.col("new_users") + F.col("returning_users") + F.col("resurrecting_users"),
        )
        .where("active_users > 0")
    )
    return weeks.select(
        "wk",
        *[f"{s}_users" for s in states],
        "active_users",
        *[percent(f"{s}_users", "active_users", 1).alias(f"{s}_pct") for s in states],
    ).orderBy("wk")
