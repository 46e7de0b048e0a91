"""Funnels, retention, activity, sessions: edge frames and brute force."""

from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import by, dicts, rows
from tidemark.operators import activity, funnel, retention, sessions

EVENTS = "event_id BIGINT, user_id BIGINT, session_id BIGINT, event_time TIMESTAMP_NTZ, event_name STRING"
USERS = "user_id BIGINT, signup_date DATE"
quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def acts(make, pairs):
    """Events from (user, time) pairs."""
    return make(
        EVENTS, [(i, u, u * 10, t, "x") for i, (u, t) in enumerate(pairs)]
    )


# ------------------------------------------------------------------- funnel


def test_funnel_counts_sessions_once_and_skips_absent_steps(make):
    e = make(
        EVENTS,
        [
            (1, 1, 10, "2024-01-01", "open"),
            (2, 1, 10, "2024-01-01", "open"),
            (3, 2, 20, "2024-01-01", "open"),
            (4, 1, 10, "2024-01-01", "pay"),
            (5, 1, 10, "2024-01-01", "noise"),
        ],
    )
    got = rows(funnel.funnel(e, ["open", "view", "pay"]))
    assert got == [("open", 2, 1, 100.0, None), ("pay", 1, 2, 50.0, 50.0)]


def test_funnel_drop_separates_relative_from_absolute_loss(make):
    sizes = {"a": 100, "b": 60, "c": 50, "d": 5}
    e = make(
        EVENTS,
        [(i, i, i, "2024-01-01", step) for step, n in sizes.items() for i in range(n)],
    )
    got = by(funnel.funnel_drop(e, list(sizes)), "event_name")
    assert [s for s in sizes if got[s]["sharpest"]] == ["d"]  # 90 percent
    assert [s for s in sizes if got[s]["largest"]] == ["d"]  # 45 against 40
    assert got["b"]["sessions_lost"] == 40 and got["b"]["loss_rank"] == 2
    assert got["a"]["loss_rank"] is None
    assert [r["event_name"] for r in dicts(funnel.loss_table(e, list(sizes)))] == ["d", "b", "c"]


# ---------------------------------------------------------------- retention


def test_retention_is_on_the_exact_day_and_keeps_inactive_users(make):
    users = make(USERS, [(1, "2024-01-05"), (2, "2024-01-31"), (3, "2024-01-20")])
    e = acts(
        make,
        [
            (1, "2024-01-06 09:00:00"),
            (1, "2024-01-06 10:00:00"),
            (1, "2024-01-11"),  # day 6
            (1, "2024-01-13"),  # day 8
            (2, "2024-02-07 23:59:59"),  # day 7
        ],
    )
    (row,) = rows(retention.nday_retention(users, e, (1, 7, 30)))
    assert row == (date(2024, 1, 1), 3, 33.33, 33.33, 0.0)
    assert rows(retention.nday_retention(users, e, (1, 7), grain=None)) == [(3, 33.33, 33.33)]


def test_rolling_window_includes_its_start_and_excludes_its_end(make):
    users = make(USERS, [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-01")])
    e = acts(make, [(1, "2024-01-08"), (2, "2024-02-07"), (2, "2024-01-07")])
    (row,) = rows(retention.rolling_retention(users, e, (7, 14), 30))
    # user 1 on day 7, user 2 on days 6 and 37
    assert row == (date(2024, 1, 1), 3, 33.33, 33.33)


def test_censored_cohort_is_null_not_zero(make):
    users = make(USERS, [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-02-01")])
    e = acts(make, [(1, "2024-01-08"), (3, "2024-02-03")])  # last day February 3
    got = by(retention.censored_retention(users, e, (1, 7)), "cohort")
    january, february = got[date(2024, 1, 1)], got[date(2024, 2, 1)]
    assert (january["cov7"], january["d7"]) == (1.0, 50.0)
    assert (february["cov1"], february["d1"]) == (1.0, 0.0)
    assert (february["cov7"], february["d7"]) == (0.0, None)
    means = rows(retention.censored_means(retention.censored_retention(users, e, (1, 7)), (1, 7)))
    assert means == [(2, 1, 0.0, 50.0)]


@quick
@given(
    signups=st.lists(st.integers(0, 6), min_size=1, max_size=5),
    pairs=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 20)), max_size=40),
)
def test_retention_equals_brute_force(make, signups, pairs):
    start = date(2024, 1, 1)
    users = make(USERS, [(i, str(start + timedelta(days=s))) for i, s in enumerate(signups)])
    e = acts(make, [(u, str(start + timedelta(days=d))) for u, d in pairs])
    seen, n = set(pairs), len(signups)

    def share(hits):
        return pytest.approx(100 * sum(hits) / n, abs=0.0051)

    point = rows(retention.nday_retention(users, e, (1, 5), grain=None))
    assert point == [
        (n, *[share((i, s + d) in seen for i, s in enumerate(signups)) for d in (1, 5)])
    ]
    rolling = rows(retention.rolling_retention(users, e, (2, 6), 4, grain="year"))
    assert rolling == [
        (
            start,
            n,
            *[
                share(
                    any((i, s + d + k) in seen for k in range(4)) for i, s in enumerate(signups)
                )
                for d in (2, 6)
            ],
        )
    ]


# ----------------------------------------------------------------- activity


def test_mau_window_holds_27_but_not_28_days_ago(make):
    e = acts(make, [(1, "2024-01-01"), (2, "2024-01-28"), (3, "2024-01-29")])
    got = rows(activity.stickiness(e))
    assert [(str(d), dau, mau) for d, dau, mau, _ in got] == [
        ("2024-01-01", 1, 1),
        ("2024-01-28", 1, 2),
        ("2024-01-29", 1, 2),
    ]


@quick
@given(
    pairs=st.lists(st.tuples(st.integers(1, 4), st.integers(0, 40)), min_size=1, max_size=40),
    width=st.integers(1, 10),
)
def test_stickiness_equals_the_range_join(make, pairs, width):
    start = datetime(2024, 1, 1)
    e = acts(make, [(u, (start + timedelta(days=d)).isoformat()) for u, d in pairs])
    got = {r[0]: (r[1], r[2]) for r in rows(activity.stickiness(e, width))}
    want = {
        (start + timedelta(days=d)).date(): (
            len({u for u, x in pairs if x == d}),
            len({u for u, x in pairs if d - width < x <= d}),
        )
        for _, d in pairs
    }
    assert got == want


def test_warmup_is_masked(make):
    e = acts(make, [(1, "2024-01-01"), (1, "2024-01-28"), (1, "2024-01-29")])
    got = rows(activity.mask_warmup(activity.stickiness(e)).orderBy("d"))
    assert [r[3] for r in got] == [None, None, 100.0]


def test_moving_average_uses_rows_and_is_short_at_first(make):
    series = make("d DATE, dau BIGINT", [("2024-01-01", 1), ("2024-01-05", 3), ("2024-01-09", 8)])
    got = rows(activity.moving_average(series, rows=2))
    assert [r[2] for r in got] == [1.0, 2.0, 5.5]


def test_streaks(make):
    e = acts(
        make,
        [(1, f"2024-01-0{d}") for d in (1, 2, 3, 7, 8)]
        + [(2, "2024-01-31"), (2, "2024-02-01")]
        + [(3, "2024-01-01 01:00:00"), (3, "2024-01-01 02:00:00")],
    )
    assert rows(activity.longest_streak(e)) == [(1, 3), (2, 2), (3, 1)]
    assert rows(activity.longest_streak(e, limit=1)) == [(1, 3)]


def test_lifecycle_states(make):
    e = acts(
        make,
        [
            (1, "2024-01-01"), (1, "2024-01-08"), (1, "2024-01-22"),  # skips one week
            (2, "2024-01-02"),
            (3, "2024-01-22"),
        ],
    )
    got = by(activity.lifecycle(e), "wk")
    states = ("new_users", "returning_users", "resurrecting_users", "dormant_users")
    assert {str(w): tuple(r[s] for s in states) for w, r in got.items()} == {
        "2024-01-01": (2, 0, 0, 0),
        "2024-01-08": (0, 1, 0, 1),
        # nobody is active in the week of January 15: it is not shown
        "2024-01-22": (1, 0, 1, 0),
    }


# ----------------------------------------------------------------- sessions


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_slot_with_a_third_of_all_events_is_dealt_out(spark, adaptive):
    """One user has a third of the events within one gap of days, others a few each."""
    n = 60_000
    hot = F.col("id") < n // 3
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    seconds = F.when(hot, F.col("id") % 80_000).otherwise(F.col("id") % 37 * 400_000)
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(hot, 7).otherwise(1000 + F.col("id") % 5000).cast("long").alias("user_id"),
        (start + F.make_dt_interval(secs=seconds)).alias("event_time"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = sessions.sessionize(events, 3 * 86_400)
        share = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        # the count of sessions by comparing every event with the one before
        before = F.lag("event_time").over(Window.partitionBy("user_id").orderBy("event_time"))
        new = before.isNull() | (F.col("event_time") - before > F.expr("INTERVAL '3' DAY"))
        upto = Window.partitionBy("user_id").orderBy("event_time").rangeBetween(Window.unboundedPreceding, 0)
        plain = events.withColumn("new", new.cast("int")).select("event_id", F.sum("new").over(upto).alias("no"))
        assert got.join(plain, "event_id").where("session_no <=> no").count() == n
        if adaptive == "false":
            assert share < 2 * n / 16
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastExchange") == 1  # of fewer than HOT rows
            assert plan.count("Range (") == 2  # the slots once, the events once
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_events_with_clashing_columns(make):
    e = make(
        "user_id BIGINT, event_time TIMESTAMP_NTZ, _user INT, _slot INT, _part INT, _parts INT, _no INT",
        [(1, "2024-01-01", 1, 2, 3, 4, 5), (1, "2024-01-02", 1, 2, 3, 4, 5)],
    )
    got = rows(sessions.sessionize(e).orderBy("event_time"))
    assert [(r[2:]) for r in got] == [(1, 2, 3, 4, 5, 1), (1, 2, 3, 4, 5, 2)]


def test_a_gap_of_exactly_the_limit_stays_in_the_session(make):
    times = ["10:00:00", "10:29:59", "10:59:59", "11:30:00", "11:30:00"]
    e = acts(make, [(1, f"2024-01-01 {t}") for t in times])
    got = rows(sessions.sessionize(e).select("event_id", "session_no").orderBy("event_id"))
    assert got == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)]


@quick
@given(
    seconds=st.lists(
        st.tuples(st.integers(1, 2), st.integers(-5000, 20000)), min_size=1, max_size=40
    ),
    gap=st.sampled_from([1, 7, 60, 1800]),
)
def test_sessions_equal_brute_force(make, seconds, gap):
    start = datetime(1970, 1, 1)
    e = acts(make, [(u, (start + timedelta(seconds=s)).isoformat()) for u, s in seconds])
    per_user = defaultdict(list)
    for u, s in seconds:
        per_user[u].append(s)
    want = []
    for u, times in per_user.items():
        times.sort()
        number, size = 1, 1
        for a, b in zip(times, times[1:]):
            if b - a > gap:
                want.append((u, number, size))
                number, size = number + 1, 0
            size += 1
        want.append((u, number, size))
    got = sessions.sessions(e, gap, true_id=None).select("user_id", "session_no", "events")
    assert sorted(rows(got)) == sorted(want)


def test_session_metrics_find_merged_sessions(make):
    e = make(
        EVENTS,
        [
            (1, 1, 10, "2024-01-01 10:00:59", "a"),
            (2, 1, 11, "2024-01-01 10:01:01", "a"),  # close to a different session
            (3, 1, 12, "2024-01-01 12:00:00", "a"),
        ],
    )
    got = {r["metric"]: r["value"] for r in dicts(sessions.session_metrics(e))}
    assert got["derived_sessions"] == 2 and got["true_sessions"] == 3
    assert got["merged_pairs"] == 1 and got["fidelity_pct"] == 66.7
    assert got["median_duration_min"] == 0.5  # one minute boundary and none


def test_a_hot_user_is_folded_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    hot = spark.range(30000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.col("id").alias("session_id"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).cast("timestamp_ntz").alias("event_time"),
    )
    got = sessions.sessions(hot, 1800).where("user_id = 1")
    # the second bound is the row with id 1 itself
    assert rows(got.select("session_no", "events")) == [(1, 10001)]


@pytest.mark.parametrize("gap", [0, -5])
def test_a_gap_must_be_positive(make, gap):
    with pytest.raises(ValueError):
        sessions.sessionize(acts(make, [(1, "2024-01-01")]), gap)
