"""Point, rolling and censored retention by signup cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import day, period_of, round_to


def _cohorts(users: DataFrame, grain: str | None, user: str, signup: str) -> DataFrame:
    cohort = F.lit(None).cast("date") if grain is None else period_of(signup, grain)
    return users.select(
        F.col(user).alias("user_id"),
        day(signup).alias("signup"),
        cohort.alias("cohort"),
    )


def _active_days(events: DataFrame, user: str, ts: str) -> DataFrame:
    """Distinct (user, day). A user with a third of all events still yields at
    most one row per day, and most duplicates vanish before the shuffle."""
    return events.select(F.col(user).alias("user_id"), day(ts).alias("d")).distinct()


def _asked_days(cohorts: DataFrame, active: DataFrame, days) -> DataFrame:
    """One row per user and day N, with ``seen`` set when the user was active
    exactly N days after signup.

    Each user asks for a few (user, day) pairs, so the join runs on the pair the
    distinct activity is already partitioned by: the events move once.
    """
    asked = cohorts.select(
        "user_id",
        "cohort",
        F.explode(F.array(*[F.lit(n) for n in days])).alias("n"),
        "signup",
    ).withColumn("d", F.date_add("signup", F.col("n")))
    seen = active.withColumn("seen", F.lit(True))
    return asked.join(seen, ["user_id", "d"], "left")


def _counts(days):
    users = F.count_if(F.col("n") == days[0]).alias("users")
    hits = [
        F.count_if((F.col("n") == n) & F.col("seen")).alias(f"hit{n}") for n in days
    ]
    return [users, *hits]


def nday_retention(
    users: DataFrame,
    events: DataFrame,
    days=(1, 7, 30),
    grain: str | None = "month",
    user: str = "user_id",
    signup: str = "signup_date",
    ts: str = "event_time",
) -> DataFrame:
    """Share of each signup cohort active on exactly day N; users who never
    came back stay in the denominator. ``grain=None`` gives one overall row."""
    cohorts = _cohorts(users, grain, user, signup)
    asked = _asked_days(cohorts, _active_days(events, user, ts), days)
    key = [] if grain is None else ["cohort"]
    shares = [
        round_to(
            F.col(f"hit{n}") / F.nullif(F.col("users"), F.lit(0)) * 100.0, 2
        ).alias(f"d{n}_retention")
        for n in days
    ]
    table = asked.groupBy(*key).agg(*_counts(days)).select(*key, "users", *shares)
    return table.orderBy(*key) if key else table


def rolling_retention(
    users: DataFrame,
    events: DataFrame,
    starts=(7, 14, 30, 60),
    width: int = 30,
    grain: str = "month",
    user: str = "user_id",
    signup: str = "signup_date",
    ts: str = "event_time",
) -> DataFrame:
    """Share of each cohort active at least once in [signup+D, signup+D+width).

    One join answers all windows.
    """
    cohorts = _cohorts(users, grain, user, signup)
    active = _active_days(events, user, ts)
    offset = F.datediff(F.col("d"), F.col("signup"))
    inside = {s: (offset >= s) & (offset < s + width) for s in starts}
    per_user = (
        cohorts.join(active, "user_id", "left")
        .groupBy("user_id", "cohort")
        .agg(*[F.bool_or(flag).alias(f"w{s}") for s, flag in inside.items()])
    )
    return (
        per_user.groupBy("cohort")
        .agg(
            F.count(F.lit(1)).alias("users"),
            *[F.count_if(F.col(f"w{s}")).alias(f"w{s}") for s in starts],
        )
        .select(
            "cohort",
            "users",
            *[
                round_to(F.col(f"w{s}") / F.col("users") * 100.0, 2).alias(f"win_{s}d")
                for s in starts
            ],
        )
        .orderBy("cohort")
    )


def censored_retention(
    users: DataFrame,
    events: DataFrame,
    days=(1, 7, 30),
    grain: str = "month",
    min_coverage: float = 0.95,
    user: str = "user_id",
    signup: str = "signup_date",
    ts: str = "event_time",
) -> DataFrame:
    """N-day retention over the users whose day N can have been observed.

    A user is eligible when signup+N is not after the last day in the events.
    ``cov{n}`` is the eligible share of the cohort; below ``min_coverage`` the
    retention is NULL instead of a number that reads as churn.
    """
    cohorts = _cohorts(users, grain, user, signup)
    last_day = events.agg(F.max(day(ts))).scalar()
    observable = [
        F.count_if((F.col("n") == n) & (F.col("d") <= F.col("_last"))).alias(f"elig{n}")
        for n in days
    ]
    counted = (
        _asked_days(cohorts, _active_days(events, user, ts), days)
        .withColumn("_last", last_day)
        .groupBy("cohort")
        .agg(*_counts(days), *observable)
    )
    columns = []
    for n in days:
        coverage = F.col(f"elig{n}") / F.col("users")
        share = F.col(f"hit{n}") / F.nullif(F.col(f"elig{n}"), F.lit(0)) * 100.0
        columns.append(round_to(coverage, 4).alias(f"cov{n}"))
        columns.append(
            round_to(F.when(coverage >= min_coverage, share), 2).alias(f"d{n}")
        )
    return counted.select("cohort", "users", *columns).orderBy("cohort")


def censored_means(retention: DataFrame, days=(1, 7, 30)) -> DataFrame:
    """Mean retention per day N over the cohorts that are observable."""
    return retention.agg(
        *[F.count(f"d{n}").alias(f"cohorts_d{n}") for n in days],
        *[round_to(F.avg(f"d{n}"), 1).alias(f"mean_d{n}") for n in days],
    )
