"""Every query gives the rows of its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adtally.plans.oracle import ORACLE
from adtally.plans.queries import QUERIES
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, con, name):
    differences, rows = compare(spark, con, name, SF)
    assert not differences
    assert rows > 0 or name == "ip_blocklist"  # no address is busy enough at this scale


def test_queries_without_twin():
    assert set(QUERIES) - set(ORACLE) == {"ctr_model_metrics", "ctr_weights"}
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).count() > 0


PLANNED = [
    name for name in QUERIES
    if not name.startswith(("stream_report", "stream_replay", "stream_sliding", "partition_", "ctr_"))
]


@pytest.mark.parametrize("name", PLANNED)
def test_plan(spark, name):
    """No cross join and no Python operator."""
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan
