"""Every registered query against its SQL check on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, CHECKS[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "razao_social" and df.count() > 0
