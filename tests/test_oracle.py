"""Every registered query with SQL must give the same rows as DuckDB."""

import pytest

from obs_analytics.plans.registry import REGISTRY

from .conftest import SF001
from .oracle_harness import compare, duck

SQL_QUERIES = [n for n, q in REGISTRY.items() if q.sql]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_matches_sql(spark, con, name):
    ok, msg = compare(spark, con, REGISTRY[name], SF001)
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert set(df.columns) >= {"SLOPE", "TREND"}
    assert df.count() == 1
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) > len(o)  # trained-model queries have no SQL
