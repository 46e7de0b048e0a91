"""No job of a training-data query pairs all rows."""

import pytest

from tests.conftest import SMALL
from tests.test_executed_plans import executions, without_broadcasts  # noqa: F401
from tidemark.llm.queries import QUERIES

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_in_any_job(spark, without_broadcasts, name):  # noqa: F811
    before = executions(spark)
    QUERIES[name](spark, SMALL).collect()
    ran = {k: plan for k, plan in executions(spark).items() if k not in before}
    assert ran
    for plan in ran.values():
        assert not [word for word in BANNED if word in plan]
