"""Every named query equals its SQL oracle on the smallest tables."""

import os

import pytest
from compare import differences

from oracles import ORACLES
from stallmetrics.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    rows, diff = differences(QUERIES[name](spark, FOLDER), FOLDER, ORACLES[name])
    assert not diff
    assert rows > 0


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "stream" not in n])
def test_plan_has_no_pairing_of_all_rows(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
