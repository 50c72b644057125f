"""Every query with an oracle equals its DuckDB SQL on the driver tables (sf0.001:
most quiet days and empty windows, the best null-path check)."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

from conftest import SF001

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    same, n, _, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert same, detail


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "quakes_7d"] and df.count() > 0
