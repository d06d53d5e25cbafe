"""Plans of the registered queries: no pair-making joins; no Python where the operator is native."""

import pytest

from starwash.llm.queries import QUERIES

PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
NATIVE = ("op2_pii", "op3_url_filter", "op8_decontaminate", "op9_fingerprint", "op10_line_dedup")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_node(spark, sf_small, name):
    plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PAIRS + (PYTHON if name in NATIVE else ()))
