"""Every query against its SQL twin, on the smallest tables."""

import pytest

from tests.conftest import SMALL
from workload.check import compare, open_oracle
from workload.oracle import oracle_sql
from workload.suite import QUERIES


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SMALL)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == oracle_sql().keys()


# neither all-pairs joins nor rows handed to Python
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, oracle, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in BANNED if word in plan]
    # a check that finds nothing at this size returns no rows, as its twin does
    assert compare(df, oracle, name) in (None, "EMPTY")
