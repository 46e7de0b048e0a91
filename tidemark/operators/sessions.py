"""Sessions rebuilt from raw timestamps.

Two events less than the gap apart always share a session, so events are first
folded into per-user time slots no longer than the gap. Only slots are ordered
per user: a user with a third of all events is reduced map-side to at most one
row per slot, and no task ever sorts a user's raw events.

Labelling the events themselves moves them once, by user and slot. A slot that holds
more than one in ``HOT`` of all events is cut into parts of about one in ``SPREAD``,
which get a copy of its label each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import epoch_minutes, epoch_seconds, percent

HOT, SPREAD = 256, 1024


def _slot(ts, gap_seconds: int):
    return F.floor(epoch_seconds(ts) / F.lit(gap_seconds)).cast("long")


def _slots(
    events: DataFrame, gap_seconds: int, user: str, ts: str, true_id: str | None = None
) -> DataFrame:
    """One row per (user, slot): first and last event, their number, and the range of ids."""
    if gap_seconds < 1:
        raise ValueError("gap_seconds must be at least 1")
    marks = [
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("events"),
    ]
    if true_id is not None:
        marks += [F.min(true_id).alias("min_id"), F.max(true_id).alias("max_id")]
    folded = (
        events.where(F.col(ts).isNotNull())
        .withColumn("slot", _slot(ts, gap_seconds))
        .where("slot IS NOT NULL")  # said here, since a join would say it to its side only
        .groupBy(F.col(user).alias("user_id"), "slot")
        .agg(F.struct(*marks).alias("marks"))
    )
    # unpacked by a generator, all readings need the same columns and share a shuffle
    return folded.select("user_id", "slot", F.inline(F.array("marks")))


def _numbered(slots: DataFrame, gap_seconds: int) -> DataFrame:
    """Slots with the number of their session."""
    per_user = Window.partitionBy("user_id").orderBy("slot")
    silence = F.col("first_ts") - F.lag("last_ts").over(per_user)
    gap = F.expr(f"INTERVAL '{gap_seconds}' SECOND")
    # a user's first slot has no silence before it
    starts = F.coalesce(silence > gap, F.lit(True)).cast("int")
    return slots.withColumn("starts", starts).withColumn(
        "session_no", F.sum("starts").over(per_user)
    )


def sessionize(
    events: DataFrame,
    gap_seconds: int = 1800,
    user: str = "user_id",
    ts: str = "event_time",
) -> DataFrame:
    """``events`` with ``session_no``, counted from 1 per user.

    A new session starts when the silence since the user's previous event
    exceeds the gap; a silence of exactly the gap continues it. Anonymous events
    are taken as one user's. An event without a time belongs to no session: it
    stays, with a NULL ``session_no``.
    """
    slots = _slots(events, gap_seconds, user, ts)
    everything = slots.agg(F.sum("events")).scalar()
    parts = F.when(
        F.col("events") * HOT > F.col("_all"), F.ceil(F.col("events") * SPREAD / F.col("_all"))
    ).otherwise(1)
    sized = slots.withColumn("_all", everything).withColumn("_parts", parts.cast("long"))
    # fewer than HOT rows hold more than one in HOT of the events
    hot = F.broadcast(
        sized.where("_parts > 1").select(
            F.col("user_id").alias("_user"), F.col("slot").alias("_slot"), "_parts"
        )
    )
    labels = _numbered(sized, gap_seconds).select(
        F.col("user_id").alias("_user"),
        F.col("slot").alias("_slot"),
        F.col("session_no").alias("_no"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"),
    )

    def at_slot(side: str):
        return F.col(f"e.`{user}`").eqNullSafe(F.col(f"{side}._user")) & (
            _slot(F.col(f"e.`{ts}`"), gap_seconds) == F.col(f"{side}._slot")
        )

    # events that are equal in all of these stay together
    told_apart = [
        F.col(f"e.`{f.name}`") for f in events.schema if "map<" not in f.dataType.simpleString()
    ]
    part = F.pmod(F.xxhash64(*told_apart), F.coalesce(F.col("hot._parts"), F.lit(1)))
    own = "_part" + "_" * max(map(len, events.columns))  # no column's name is as long
    dealt = (
        events.alias("e").join(hot.alias("hot"), at_slot("hot"), "left").select("e.*", part.alias(own))
    )
    match = at_slot("labels") & (F.col(own) == F.col("labels._part"))
    others = [F.col(f"e.`{c}`") for c in events.columns if c != "session_no"]
    return (
        dealt.alias("e")
        .join(labels.alias("labels"), match, "left")
        .select(*others, F.col("labels._no").alias("session_no"))
    )


def sessions(
    events: DataFrame,
    gap_seconds: int = 1800,
    user: str = "user_id",
    ts: str = "event_time",
    true_id: str | None = "session_id",
) -> DataFrame:
    """One row per rebuilt session: events, first and last time, duration in
    minute boundaries, and whether it covers several given session ids. Events
    without a time belong to none."""
    slots = _numbered(_slots(events, gap_seconds, user, ts, true_id), gap_seconds)
    folded = [
        F.sum("events").alias("events"),
        F.min("first_ts").alias("started_at"),
        F.max("last_ts").alias("ended_at"),
    ]
    if true_id is not None:
        # several distinct ids exactly when the smallest is not the largest
        folded.append((F.min("min_id") < F.max("max_id")).alias("merged"))
    return (
        slots.groupBy("user_id", "session_no")
        .agg(*folded)
        .withColumn(
            "duration_min", epoch_minutes("ended_at") - epoch_minutes("started_at")
        )
    )


def session_metrics(
    events: DataFrame,
    gap_seconds: int = 1800,
    user: str = "user_id",
    ts: str = "event_time",
    true_id: str = "session_id",
) -> DataFrame:
    """Fidelity against the given session ids and session depth, as
    (metric, value) rows."""
    rebuilt = sessions(events, gap_seconds, user, ts, true_id)
    # whole numbers: percentile() keeps one counter per distinct length
    summary = rebuilt.agg(
        F.count(F.lit(1)).alias("derived_sessions"),
        F.count_if("merged").alias("merged_pairs"),
        F.count_if(F.col("events") == 1).alias("sessions_1_event"),
        F.count_if(F.col("events").between(2, 3)).alias("sessions_2_3_events"),
        F.count_if(F.col("events").between(4, 5)).alias("sessions_4_5_events"),
        F.count_if(F.col("events") >= 6).alias("sessions_6plus_events"),
        F.percentile("events", 0.5).alias("median_events_per_session"),
        F.percentile("duration_min", 0.5).alias("median_duration_min"),
    )
    given = events.agg(F.countDistinct(true_id)).scalar()
    full = summary.withColumn("true_sessions", given).withColumn(
        "fidelity_pct", percent("derived_sessions", "true_sessions", 1)
    )
    names = [
        "derived_sessions",
        "true_sessions",
        "fidelity_pct",
        "merged_pairs",
        "sessions_1_event",
        "sessions_2_3_events",
        "sessions_4_5_events",
        "sessions_6plus_events",
        "median_events_per_session",
        "median_duration_min",
    ]
    return long_form(full, names)


def long_form(row: DataFrame, names: list[str]) -> DataFrame:
    """A one-row frame as (metric, value) rows, values as double."""
    doubles = row.select(*[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot([], names, "metric", "value")
