"""Every registered query against its SQL counterpart, and the shape of its plan."""

import pytest

import __spark_entry__ as driver
from compare import compare, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    _, equal, message = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert equal, message


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_nested_loop_or_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoopJoin", "CartesianProduct", "Python", "Pandas"):
        assert operator not in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0
