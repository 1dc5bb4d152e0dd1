"""Queries of the operators that SQL expresses, on the smallest given tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from adtide.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    schema, ours, theirs, only = differences(QUERIES[name](spark, FOLDER), ORACLES[name], connect(FOLDER))
    assert schema == [] and only == [] and ours == theirs > 0
