"""Anonymous and undated events, and values that are not money, by hand and by SQL."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import dicts, rows
from tidemark.functions import total_money
from tidemark.operators import activity, profile, revenue, sessions, subscriptions, summary
from tidemark.sources import clean_invoice_lines

EVENTS = [
    (1, "2024-01-01T10:00:00"),
    (None, "2024-01-01T10:00:00"),
    (None, "2024-01-03T10:00:00"),
    (2, None),
    (2, "2024-01-08T09:00:00"),
    (1, "2024-01-08T09:00:00"),
    (None, None),
]
SCHEMA = "user_id BIGINT, event_time TIMESTAMP_NTZ"


def test_stickiness_counts_known_users_on_every_dated_day(make):
    got = rows(activity.stickiness(make(SCHEMA, EVENTS)).selectExpr("string(d)", "dau", "mau", "stickiness_pct"))
    assert got == [
        ("2024-01-01", 1, 1, 100.0),
        ("2024-01-03", 0, 1, 0.0),
        ("2024-01-08", 2, 2, 100.0),
    ]
    alone = make(SCHEMA, [(None, "2024-01-01T10:00:00")])
    assert rows(activity.stickiness(alone).select("dau", "mau", "stickiness_pct")) == [(0, 0, None)]


def test_daily_users_and_streaks_leave_undated_events_out(make):
    events = make(SCHEMA, EVENTS)
    got = activity.daily_users(events).selectExpr("string(d)", "dau")
    assert dict(rows(got)) == {"2024-01-01": 1, "2024-01-03": 0, "2024-01-08": 2}
    assert {r[0] for r in rows(activity.longest_streak(events, None))} == {1, 2}


def test_lifecycle_counts_known_users_in_known_weeks(make):
    got = dicts(activity.lifecycle(make(SCHEMA, EVENTS)))
    assert [(str(r["wk"]), r["new_users"], r["returning_users"]) for r in got] == [
        ("2024-01-01", 1, 0),
        ("2024-01-08", 1, 1),
    ]


def test_sessionize_returns_every_event(make):
    events = make(SCHEMA + ", slot INT, session_no INT", [(*e, 7, 8) for e in EVENTS])
    got = sessions.sessionize(events)
    assert got.columns == ["user_id", "event_time", "slot", "session_no"]
    found = rows(got.selectExpr("user_id", "string(event_time)", "session_no"))
    assert len(found) == len(EVENTS)
    assert all((no is None) == (ts is None) for _, ts, no in found)
    assert {no for user, _, no in found if user == 1} == {1, 2}
    with_ids = events.withColumn("session_id", F.lit(1))
    metrics = dict(rows(sessions.session_metrics(with_ids)))
    assert metrics["derived_sessions"] == 5


@pytest.mark.parametrize("x", [1e15, 2e15, 0.00001, math.nan, math.inf])
def test_metrics_are_not_taken_for_money(spark, x):
    df = spark.createDataFrame([("a", x), ("b", 1.0)], "s STRING, x DOUBLE")
    got = {r["s"]: r for r in dicts(summary.metric_by_segment(df, "x", "s"))}
    if math.isnan(x):
        assert math.isnan(got["a"]["total"]) and math.isnan(got["a"]["mean"])
    else:
        assert got["a"]["mean"] == pytest.approx(x, abs=1e-4) and got["b"]["total"] == 1.0


def test_fine_sums_keep_their_digits(spark):
    df = spark.range(1000).select(F.lit("a").alias("s"), F.lit(0.00001).alias("x"))
    assert dicts(summary.metric_by_segment(df, "x", "s"))[0]["total"] == 0.01


@pytest.mark.parametrize("x", [math.nan, math.inf, 1e15])
def test_what_is_not_money_fails(spark, x):
    with pytest.raises(Exception, match="not an amount of money"):
        rows(spark.createDataFrame([(x,)], "x DOUBLE").agg(total_money("x")))
    assert rows(spark.createDataFrame([(None,)], "x DOUBLE").agg(total_money("x"))) == [(None,)]


def test_values_missing_from_a_pivot_list_fail(make):
    orders = make(
        "order_ts TIMESTAMP_NTZ, product_category STRING, amount DOUBLE",
        [("2024-01-01T00:00:00", "a", 1.0), ("2024-01-01T00:00:00", "b", 2.0)],
    )
    assert rows(revenue.pivot_revenue(orders).select("a", "b")) == [(1.0, 2.0)]
    with pytest.raises(Exception, match="not listed"):
        rows(revenue.pivot_revenue(orders, ["a"]))
    triangle = make("cohort DATE, period BIGINT, revenue DOUBLE", [("2024-01-01", 0, 1.0), ("2024-01-01", 9, 2.0)])
    assert triangle.count() == 2
    assert revenue.triangle_matrix(triangle).columns == ["cohort", "m0", "m9"]
    with pytest.raises(Exception, match="not listed"):
        rows(revenue.triangle_matrix(triangle, [0, 1]))


def test_columns_without_values_stay_in_profiles(spark):
    df = spark.createDataFrame([(1.0, None, None), (3.0, None, None)], "x DOUBLE, y DOUBLE, c STRING")
    got = {r["column_name"]: r for r in dicts(profile.profile_numeric(df, ["x", "y"]))}
    assert got["x"]["n"] == 2 and got["y"]["n"] == 0 and got["y"]["median"] is None
    assert rows(profile.profile_categorical(df, ["c"])) == [("c", 0, None, 0, None)]


@pytest.mark.parametrize("cell", ["2.5", "3.5", "3000000000", "12.0", "x", "", "-1.5"])
def test_customer_ids_are_read_as_sql_reads_them(spark, cell):
    columns = ["Invoice", "StockCode", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    df = spark.createDataFrame([("1", "2", "3", "4", "5", cell, "7")], ", ".join(f"`{c}` STRING" for c in columns))
    want = duckdb.execute("SELECT try_cast(? AS DOUBLE)", [cell]).fetchone()[0]
    want = want if want is None else duckdb.execute("SELECT try_cast(? AS BIGINT)", [want]).fetchone()[0]
    assert clean_invoice_lines(df).first()["customer_id"] == want


def test_recurring_revenue_is_divided_once(spark):
    subs = spark.range(1_000_000).select(
        F.lit("2024-01-05").cast("timestamp_ntz").alias("started_at"),
        F.lit("annual").alias("plan"),
        F.lit(89.99).alias("amount"),
    )
    assert rows(subscriptions.mrr(subs, "2024-01-01").select("mrr", "active_subs")) == [(7499166.67, 1_000_000)]


def test_partial_refunds_are_folded(make):
    orders = make(
        "order_id BIGINT, order_ts TIMESTAMP_NTZ, amount DOUBLE", [(1, "2024-01-01T00:00:00", 100.0)]
    )
    refunds = make("order_id BIGINT, amount DOUBLE", [(1, 30.0), (1, 20.0)])
    got = dicts(revenue.net_revenue(orders, refunds))[0]
    assert (got["gross"], got["refunded"], got["net"]) == (100.0, 50.0, 50.0)
