"""Every registered query with oracle SQL equals DuckDB on sf0.01."""

import pytest

from tidepool.plans import REGISTRY
from tools.oracle_check import compare, duck_connection

from conftest import SF01

WITH_SQL = [n for n, q in REGISTRY.items() if q.sql]


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_duckdb(spark, con, name):
    res = compare(spark, con, name, REGISTRY[name], SF01)
    assert res["status"] == "exact", res


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
