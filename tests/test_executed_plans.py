"""Plans of all jobs that a query runs, also of those that write its tables."""

import pytest

from tests.conftest import SMALL
from workload.suite import QUERIES

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")
# queries that run jobs while their frame is built, or several readings in one
EAGER = [
    "q15_distribution",
    "q20_rfm",
    "q23_pareto",
    "e12_concentration",
    "e15_shape",
    "p02_quality",
    "p03_numeric",
    "p08_findings",
    "m07_mart_csv",
    "m07_mart_tables",
    "i05_csv_source",
    "i06_csv_text",
    "i07_json_sink",
]


@pytest.fixture
def without_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def executions(spark):
    """{id: physical plan} of what ran so far."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {
        found.apply(i).executionId(): found.apply(i).physicalPlanDescription()
        for i in range(found.size())
    }


@pytest.mark.parametrize("name", EAGER)
def test_no_job_of_a_query_pairs_all_rows_or_leaves_the_jvm(spark, without_broadcasts, name):
    before = executions(spark)
    QUERIES[name](spark, SMALL).collect()
    ran = {k: plan for k, plan in executions(spark).items() if k not in before}
    assert ran
    for plan in ran.values():
        assert not [word for word in BANNED if word in plan]


@pytest.fixture
def fixed_plans(spark):
    """Without adaptive execution a plan shows which of its shuffles are reused."""
    name = "spark.sql.adaptive.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.mark.parametrize(
    "name, tables",
    [
        ("e06_metric_by_segment", 1),
        ("e14_weekly_resample", 1),
        ("p07_weekly_trend", 1),
        ("p06_metric_by_country", 4),
        ("p04_categorical", 4),
        ("i09_clean_purchases", 2),
    ],
)
def test_a_source_is_read_once(spark, fixed_plans, name, tables):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == tables
