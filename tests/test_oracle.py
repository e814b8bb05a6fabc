"""Every registered query against its SQL oracle at the smallest scale factor."""

import pytest
from oracle_check import difference, duck

import __spark_entry__ as entry
from isotherm.plans.oracle import ORACLE
from isotherm.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, connection, name):
    frame = entry.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # no query pairs unrelated rows
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    result = frame.toArrow()
    assert result.num_rows > 0
    assert difference(result, connection.sql(entry.oracle_sql()[name]).to_arrow_table()) is None


def test_only_the_forest_has_no_oracle():
    assert set(REGISTRY) - set(ORACLE) == {"rf_predictions"}
    assert not set(ORACLE) - set(REGISTRY)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and len(result.columns) == 27
