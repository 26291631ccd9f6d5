"""Every query that SQL can express equals its oracle; the others give one row per input row."""

import os

import pytest
from compare import differences

from stallmetrics.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
NATIVE = ("op5_chat_format", "op9_mixing", "op10_url_filter")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    rows, diff = differences(QUERIES[name](spark, FOLDER), FOLDER, ORACLES[name])
    assert rows and not diff


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_all_operators_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
