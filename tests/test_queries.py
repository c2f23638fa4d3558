"""Every registered query against its SQL, on the smallest tables."""

import pytest

from lakeretrieve.registry import ORACLES, QUERIES
from tests.oracle import compare, connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    if name in ORACLES:
        assert compare(spark, con, SF_DIR, name, df) in (None, "no rows at all")
    else:
        assert df.count() > 0
