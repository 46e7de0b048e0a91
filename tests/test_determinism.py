"""The number of shuffle partitions must not change any result, and the
published invariants hold."""

import pytest

from tests.conftest import SMALL, by, dicts, rows
from workload.suite import QUERIES

NAMES = [
    "q01_funnel",
    "q04_stickiness",
    "q09_ab_test",
    "q12_top_users",
    "q15_distribution",
    "q16_session_metrics",
    "q18_revenue_triangle",
    "q20_rfm",
    "q21_churn",
    "q23_pareto",
    "q26_repeat_concentration",
    "e12_concentration",
    "p03_numeric",
]


@pytest.mark.parametrize("name", NAMES)
def test_partitions_do_not_matter(spark, name):
    results = []
    try:
        for partitions, adaptive in ((1, "true"), (16, "false")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            results.append(sorted(rows(QUERIES[name](spark, SMALL)), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert results[0] == results[1]


def run(spark, name):
    return dicts(QUERIES[name](spark, SMALL))


def test_rolling_windows_hold_at_least_zero_and_at_most_all(spark):
    for row in run(spark, "q03_rolling_retention"):
        assert all(0 <= v <= 100 for k, v in row.items() if k.startswith("win_"))


def test_dau_never_exceeds_mau(spark):
    assert all(r["dau"] <= r["mau"] for r in run(spark, "q04_stickiness"))


def test_every_customer_is_in_one_cohort(spark):
    total = sum(r["users"] for r in run(spark, "q05_ltv_by_cohort"))
    assert total == run(spark, "q09_ab_test")[0]["users"] + run(spark, "q09_ab_test")[1]["users"]


def test_ranks_are_contiguous(spark):
    seen = {}
    for row in run(spark, "q06_top_categories"):
        seen.setdefault(row["country"], []).append(row["rnk"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())


def test_depth_buckets_partition_the_sessions(spark):
    m = by(QUERIES["q16_session_metrics"](spark, SMALL), "metric")
    parts = [m[f"sessions_{k}"]["value"] for k in ("1_event", "2_3_events", "4_5_events", "6plus_events")]
    assert sum(parts) == m["derived_sessions"]["value"]


def test_lifecycle_shares_add_up(spark):
    for row in run(spark, "q17_lifecycle"):
        assert row["new_pct"] + row["returning_pct"] + row["resurrecting_pct"] == pytest.approx(
            100, abs=0.2
        )


def test_quantiles_are_monotone(spark):
    assert all(r["median_amount"] <= r["p90"] <= r["p99"] for r in run(spark, "q15_distribution"))


def test_pareto_ends_at_everything(spark):
    deciles = run(spark, "q23_pareto")
    assert len(deciles) == 10 and deciles[-1]["cum_pct"] == pytest.approx(100, abs=0.1)
    revenue = [r["revenue"] for r in deciles]
    assert revenue == sorted(revenue, reverse=True)
