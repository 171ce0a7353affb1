"""Every registered query against its check SQL, on the smallest tables."""

import os

import pytest

from tests.compare import check_connection, check_rows, spark_rows
from workload.checks import CHECKS
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return check_connection(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Only a total may meet in one task, and only as one partial count per task.
    assert name == "status_totals" or "SinglePartition" not in plan
    names, rows = spark_rows(df)
    expected_names, expected = check_rows(con, CHECKS[name])
    assert names == expected_names
    assert rows == expected
    assert rows
