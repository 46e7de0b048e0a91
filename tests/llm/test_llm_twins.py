"""The queries with a SQL twin, on whole given tables."""

import pytest

from tests.conftest import SMALL
from tidemark.llm.oracle import SQL
from tidemark.llm.queries import QUERIES
from workload.check import normalised, open_oracle


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, name):
    con = open_oracle(SMALL)
    con.execute(SQL[name])
    want = normalised([c[0] for c in con.description], con.fetchall())
    df = QUERIES[name](spark, SMALL)
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == want
