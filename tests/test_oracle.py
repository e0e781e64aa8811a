"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck

_SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from handover.plans.queries import QUERIES

    assert set(QUERIES) <= set(_SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_matches_oracle(spark, con, name):
    ok, info = compare(spark, name, E.queries()[name], _SQL[name], SF_SMALL, con)
    assert ok, info


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "company_name", "avg_orders_per_month", "distinct_products"]
    assert df.count() >= 0
