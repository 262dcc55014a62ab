"""Every registered query against its DuckDB oracle on the smallest bound test data."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from mercadia.plans.catalog import queries
    assert set(queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    problems = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "revenue_rank" in df.columns
