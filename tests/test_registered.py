"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from registry.oracle import ORACLES
from registry.runs import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert refused not in plan
    schema, ours, theirs, only = differences(result, ORACLES[name], duck)
    assert schema == [] and only == [] and ours == theirs > 0
