"""Every registered query against its SQL check, on whole tables, and what its plan must not hold."""

import re

import __spark_entry__ as entry
import pytest
from checking import compare, connect

from commonspulse import catalog

SF_DIR = "/root/testdata/sf0.001"
# Queries that parse setup files with the one Python function.
WITH_PYTHON = re.compile(r"setup|depend|^a9_|^j8_|^dist_|^p4_|^p12_|^u1_|^w8_load_(repo|snap)")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_check(spark, connection, name):
    frame = catalog.QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if "EvalPython" in plan or "MapInPandas" in plan:
        assert WITH_PYTHON.search(name), "Python in a plan that needs none"
    assert compare(frame, catalog.ORACLES[name], connection) == []


def test_entry_gives_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["org_login", "month"]
    assert frame.count() > 0
