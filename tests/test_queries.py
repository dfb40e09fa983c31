"""Every registered query at the smallest scale: against its SQL, and its plan."""

import pytest

from sparkmart.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# what must not occur in any plan: pair-everything joins, row-by-row Python, one-partition windows
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in FORBIDDEN if x in plan]
    window_over_one = [
        line for line in plan.splitlines() if "Window" in line and "partition" not in line and line.rstrip().endswith("[]")
    ]
    assert not window_over_one
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        df.count()


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["interval_slice"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    plan = QUERIES["sales_mart"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert any("p_name" in s and "p_size" not in s for s in scans)
    assert any("l_quantity" in s and "l_tax" not in s and "l_shipdate" not in s for s in scans)


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
