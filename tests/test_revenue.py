"""Revenue, buyers and subscriptions on hand-built frames."""

from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import by, dicts, rows
from tidemark.operators import anomalies, customers, revenue, subscriptions

USERS = "user_id BIGINT, signup_date DATE, channel STRING, country STRING"
ORDERS = (
    "order_id BIGINT, user_id BIGINT, order_ts TIMESTAMP_NTZ, amount DOUBLE, "
    "product_category STRING"
)
SUBS = "sub_id BIGINT, user_id BIGINT, started_at TIMESTAMP_NTZ, plan STRING, amount DOUBLE"
CANCELS = "sub_id BIGINT, cancelled_at TIMESTAMP_NTZ"


@pytest.fixture
def users(make):
    return make(
        USERS,
        [
            (1, "2024-01-10", "email", "A"),
            (2, "2024-01-20", "email", "A"),
            (3, "2024-02-01", "social", "B"),
            (4, "2024-03-01", "none", "B"),
        ],
    )


@pytest.fixture
def orders(make):
    return make(
        ORDERS,
        [
            (1, 1, "2024-01-15 10:00:00", 10.0, "x"),
            (2, 1, "2024-01-15 10:00:00", 30.0, "y"),  # same time: lower id is first
            (3, 1, "2024-03-01", 5.55, "x"),
            (4, 2, "2024-02-02", 20.0, "x"),
            (5, 3, "2024-03-05", 7.0, "z"),
        ],
    )


def test_ltv_counts_users_without_orders(users, orders):
    got = rows(revenue.ltv_by_cohort(users, orders))
    assert got == [
        (date(2024, 1, 1), 2, 65.55, 32.78),
        (date(2024, 2, 1), 1, 7.0, 7.0),
        (date(2024, 3, 1), 1, 0.0, 0.0),
    ]


def test_top_n_breaks_ties_by_item(make):
    df = make(
        "g STRING, item STRING, revenue DOUBLE",
        [("a", "q", 5.0), ("a", "p", 5.0), ("a", "r", 9.0), ("b", "p", 1.0)],
    )
    got = rows(revenue.top_n_per_group(df, "g", "item", n=2))
    assert got == [("a", "r", 9.0, 1), ("a", "p", 5.0, 2), ("b", "p", 1.0, 1)]


def test_top_n_limits_rows_before_the_shuffle(users, orders):
    top = revenue.top_users(users, orders, 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(top)[-2:] == [("B", 3, 7.0, 1), ("B", 4, 0.0, 2)]


def test_top_categories_and_their_pivot(users, orders):
    top = revenue.top_categories(users, orders, 2)
    assert rows(top) == [("A", "x", 35.55, 1), ("A", "y", 30.0, 2), ("B", "z", 7.0, 1)]
    assert rows(revenue.rank_pivot(top, "country", n=2)) == [
        ("A", 35.55, 30.0),
        ("B", 7.0, None),
    ]


def test_running_total_ends_at_the_total(orders):
    got = rows(revenue.running_total(orders))
    assert [r[1] for r in got] == [40.0, 20.0, 5.55, 7.0]
    assert got[-1][2] == 72.55


def test_attribution_takes_the_earliest_order_and_ignores_non_buyers(users, orders):
    got = by(revenue.attribution(users, orders), "channel")
    assert got["email"]["lifetime_revenue"] == 65.55
    assert got["email"]["first_touch_revenue"] == 30.0  # 10 and 20
    assert got["none"]["lifetime_revenue"] is None


def test_pivot_finds_categories_and_leaves_gaps_null(orders):
    pivoted = revenue.pivot_revenue(orders)
    assert pivoted.columns == ["month", "x", "y", "z"]
    assert [r[1:] for r in rows(pivoted)] == [
        (10.0, 30.0, None),
        (20.0, None, None),
        (5.55, None, 7.0),
    ]


def test_triangle_drops_cohorts_without_period_zero(users, orders):
    got = dicts(revenue.revenue_triangle(users, orders))
    # February's only buyer pays in March: no period 0
    assert {r["cohort"] for r in got} == {date(2024, 1, 1)}
    assert [(r["period"], r["paying_users"], r["revenue"]) for r in got] == [
        (0, 1, 40.0),
        (1, 1, 20.0),
        (2, 1, 5.55),
    ]
    assert [r["pct_of_period0"] for r in got] == [100.0, 50.0, 13.9]
    assert [r["cum_revenue"] for r in got] == [40.0, 60.0, 65.55]
    assert got[-1]["ltv_per_user"] == 32.78  # two users, one of them late


def test_triangle_matrix_fills_zero(users, orders):
    triangle = revenue.revenue_triangle(users, orders)
    matrix = revenue.triangle_matrix(triangle, [0, 1, 2, 3])
    assert rows(matrix) == [(date(2024, 1, 1), 40.0, 20.0, 5.55, 0.0)]
    assert revenue.triangle_matrix(triangle).columns == ["cohort", "m0", "m1", "m2"]


def test_net_revenue(make, orders):
    refunds = make("refund_id BIGINT, order_id BIGINT, amount DOUBLE", [(1, 2, 15.0)])
    got = rows(revenue.net_revenue(orders, refunds))
    assert got[0] == (date(2024, 1, 1), 40.0, 15.0, 25.0, 37.5)
    assert got[1][1:] == (20.0, 0.0, 20.0, 0.0)
    per_category = by(revenue.net_revenue(orders, refunds, "product_category"), "product_category")
    assert per_category["y"]["refund_rate_pct"] == 50.0
    rate = rows(revenue.refund_rate_by_orders(orders, refunds))
    assert rate == [(5, 1, 20.0)]


def test_arpu_names_its_window(orders):
    got = rows(
        revenue.revenue_per_active_user(
            orders, orders, "2024-01-01", "2024-02-29", activity_ts="order_ts"
        )
    )
    assert got == [(date(2024, 1, 1), date(2024, 2, 29), 60.0, 2, 30.0)]


@pytest.mark.parametrize("slices", [None, 5])
def test_distribution_is_exact(spark, slices):
    rng = np.random.default_rng(1)
    amounts = np.round(rng.lognormal(3, 0.5, 928), 2)
    df = spark.createDataFrame(
        [(float(a), "even" if i % 2 else "odd") for i, a in enumerate(amounts)],
        "amount DOUBLE, product_category STRING",
    )
    got = by(revenue.distribution(df, slices=slices), "product_category")
    for name, values in (("even", amounts[1::2]), ("odd", amounts[0::2])):
        row = got[name]
        assert row["orders"] == 464
        assert row["p90"] == pytest.approx(np.quantile(values, 0.9), abs=0.00501)
        assert row["median_amount"] == pytest.approx(np.median(values), abs=0.00501)
        assert row["total_revenue"] == round(float(values.sum()), 2)


def test_approximate_distribution_is_close(spark):
    df = spark.range(1, 10001).selectExpr("CAST(id AS DOUBLE) AS amount", "'x' AS product_category")
    ((_, n, median, p90, p99, total),) = rows(revenue.distribution(df, approximate=1000))
    assert (n, total) == (10000, 50005000.0)
    assert abs(median - 5000) <= 20 and abs(p90 - 9000) <= 20 and abs(p99 - 9900) <= 20


# ------------------------------------------------------------------- buyers


def test_repeat_purchase(make):
    orders = make(
        ORDERS,
        [
            (1, 1, "2024-01-01 23:59:59", 1.0, "x"),
            (2, 1, "2024-01-02 00:01:01", 1.0, "x"),  # one midnight
            (3, 1, "2024-01-02 12:00:00", 1.0, "x"),  # none
            (4, 1, "2024-01-12", 1.0, "x"),  # ten
            (5, 2, "2024-01-01", 1.0, "x"),
        ],
    )
    got = {r["metric"]: r["value"] for r in dicts(customers.repeat_purchase(orders))}
    assert got["buyers"] == 2 and got["repeat_buyers"] == 1 and got["repeat_rate_pct"] == 50.0
    assert got["median_days_between"] == 1.0 and got["p90_days_between"] == 8.0
    assert (got["buyers_1_order"], got["buyers_4plus_orders"]) == (1, 1)


def test_repeat_purchase_without_repeats_has_no_gaps(make):
    orders = make(ORDERS, [(1, 1, "2024-01-01", 1.0, "x")])
    got = {r["metric"]: r["value"] for r in dicts(customers.repeat_purchase(orders))}
    assert got["median_days_between"] is None and got["repeat_rate_pct"] == 0.0


@pytest.mark.parametrize("slices", [None, 3])
def test_rfm_ties_fall_by_user_id(make, slices):
    orders = make(
        ORDERS, [(i, i, "2024-01-01", 10.0, "x") for i in range(1, 8)]
    )
    got = by(customers.rfm(orders, slices=slices), "user_id")
    # seven equal buyers in five buckets: 2, 2, 1, 1, 1
    assert [got[u]["r"] for u in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    assert [got[u]["m"] for u in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    assert got[7]["segment"] == "Champions" and got[5]["segment"] == "Regular"
    assert {r["f"] for r in got.values()} == {1}


def test_rfm_segments_add_up(make):
    orders = make(
        ORDERS,
        [(i, i % 23, f"2024-01-{1 + i % 28:02d}", 1.0 + i, "x") for i in range(100)],
    )
    scored = customers.rfm(orders)
    got = dicts(customers.rfm_segments(scored))
    assert sum(r["buyers"] for r in got) == 23
    assert sum(r["revenue"] for r in got) == pytest.approx(sum(1.0 + i for i in range(100)))
    assert sum(r["pct_of_revenue"] for r in got) == pytest.approx(100, abs=0.4)
    assert sum(r["buyers"] for r in dicts(customers.rfm_profile(scored))) == 23


def test_pareto_with_fewer_buyers_than_deciles(make):
    orders = make(ORDERS, [(i, i, "2024-01-01", float(i), "x") for i in (1, 2, 3)])
    got = rows(customers.pareto(orders))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 1, 3.0), (2, 1, 2.0), (3, 1, 1.0)]
    assert [r[5] for r in got] == [50.0, 83.33, 100.0]


def test_concentration_keeps_tied_customers_together(make):
    df = make("customer_id BIGINT, revenue DOUBLE", [(i, 10.0) for i in range(20)])
    df = df.withColumn("revenue", df.revenue.cast("decimal(20,2)"))
    # by NTILE two of twenty are the top decile; by PERCENT_RANK all share rank 0
    assert rows(customers.concentration(df, slices=3)) == [(10.0, 100.0, 20.0)]


def test_subscription_conversion(make, orders):
    subs = make(SUBS, [(1, 1, "2024-01-18", "monthly", 9.99), (2, 9, "2024-01-18", "annual", 89.99)])
    got = {r["metric"]: r["value"] for r in dicts(customers.subscription_conversion(orders, subs))}
    assert got["purchasers"] == 3 and got["subscribers"] == 1 and got["conversion_pct"] == 33.3
    assert got["monthly_subs"] == 1 and got["annual_subs"] == 0
    assert got["median_days_to_convert"] == 3.0


# ------------------------------------------------------------ subscriptions


def test_mrr_keeps_one_row_of_a_late_start(make):
    subs = make(
        SUBS,
        [
            (1, 1, "2024-01-31", "monthly", 9.99),
            (2, 2, "2024-03-01", "annual", 89.99),
            (3, 3, "2024-06-15", "monthly", 5.0),  # after the end month
        ],
    )
    got = [(str(m), v, n) for m, v, n in rows(subscriptions.mrr(subs, "2024-04-01"))]
    assert got == [
        ("2024-01-01", 9.99, 1),
        ("2024-02-01", 9.99, 1),
        ("2024-03-01", 17.49, 2),
        ("2024-04-01", 17.49, 2),
        ("2024-06-01", 5.0, 1),
    ]


def test_mrr_when_everything_starts_late(make):
    subs = make(SUBS, [(1, 1, "2024-05-01", "monthly", 5.0)])
    assert rows(subscriptions.mrr(subs, "2024-04-01")) == [(date(2024, 5, 1), 5.0, 1)]


def test_churn(make):
    subs = make(
        SUBS,
        [
            (1, 1, "2024-02-10", "monthly", 10.0),
            (2, 2, "2024-02-10", "annual", 120.0),
            (3, 3, "2024-03-01", "monthly", 10.0),  # cancelled in its start month
            (4, 4, "2024-03-01", "monthly", 30.0),  # cancelled before it starts
        ],
    )
    cancels = make(
        CANCELS, [(1, "2024-04-05"), (3, "2024-03-20"), (4, "2024-02-01"), (2, "2024-06-01")]
    )
    got = rows(subscriptions.churn(subs, cancels, "2024-02-01", "2024-05-01"))
    assert [(str(r[0]), *r[1:]) for r in got] == [
        ("2024-02-01", 0, 0, None, None, None, None),
        ("2024-03-01", 2, 0, 0.0, 20.0, None, None),
        ("2024-04-01", 2, 1, 50.0, 20.0, 10.0, 50.0),
        ("2024-05-01", 1, 0, 0.0, 10.0, None, None),
    ]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    lives=st.lists(
        st.tuples(
            st.integers(1, 9), st.one_of(st.none(), st.integers(1, 12)), st.integers(100, 9999)
        ),
        min_size=1,
        max_size=25,
    )
)
def test_churn_equals_the_months_by_subscriptions_count(make, lives):
    subs = make(
        SUBS,
        [(i, i, f"2024-{b:02d}-15", "monthly", c / 100) for i, (b, _, c) in enumerate(lives)],
    )
    cancels = make(
        CANCELS, [(i, f"2024-{e:02d}-20") for i, (_, e, _) in enumerate(lives) if e]
    )
    got = rows(subscriptions.churn(subs, cancels, "2024-02-01", "2024-11-01"))
    assert len(got) == 10
    for row in got:
        m = row[0].month
        there = [(e, c) for b, e, c in lives if b < m and (e is None or e >= m)]
        gone = [c for e, c in there if e == m]
        assert row[1:3] == (len(there), len(gone))
        assert row[4] == (pytest.approx(sum(c for _, c in there) / 100) if there else None)
        assert row[5] == (pytest.approx(sum(gone) / 100) if gone else None)


def test_plan_summary(make):
    subs = make(
        SUBS, [(1, 1, "2024-02-10", "monthly", 10.0), (2, 2, "2024-02-10", "monthly", 20.0)]
    )
    cancels = make(CANCELS, [(1, "2024-04-05")])
    assert rows(subscriptions.plan_summary(subs, cancels)) == [
        ("monthly", 2, 30.0, 15.0, 1, 50.0)
    ]


# ---------------------------------------------------------------- anomalies


def test_anomalies_match_a_direct_computation(make):
    rng = np.random.default_rng(5)
    x = [float(v) for v in np.round(rng.normal(100, 10, 40), 2)]
    x[30] = 400.0
    days = [str(np.datetime64("2024-01-01") + i) for i in range(40)]
    series = make("d DATE, revenue DOUBLE", list(zip(days, x)))
    base = [np.median(x[max(0, i - 14) : i]) if i else np.nan for i in range(40)]
    got = rows(anomalies.mad_anomalies(series))
    assert len(got) == 33  # the first seven have too little history
    for d, value, median, z, flag in got:
        i = days.index(str(d))
        off = [abs(x[j] - base[j]) for j in range(max(0, i - 14), i) if j]
        want = 0.6745 * (x[i] - base[i]) / np.median(off)
        assert median == pytest.approx(base[i], abs=0.00501)
        assert z == pytest.approx(want, abs=0.00501)
        assert flag == ("YES" if abs(want) >= 3 else "")
    assert "YES" in {r[4] for r in got if str(r[0]) == days[30]}


def test_no_spread_gives_no_score(make):
    days = [f"2024-01-{i:02d}" for i in range(1, 20)]
    series = make("d DATE, revenue DOUBLE", [(d, 5.0) for d in days])
    assert {(r[3], r[4]) for r in rows(anomalies.mad_anomalies(series))} == {(None, "")}
