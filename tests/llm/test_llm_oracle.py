"""Operators that SQL can express, against DuckDB."""

import pytest

pytest.importorskip("riskgrid.llm")

from oracle_compare import compare, duck  # noqa: E402

from riskgrid.llm.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", SQL)
def test_equals_duckdb(spark, name):
    sf = "/root/testdata/sf0.01"
    same, *_, detail = compare(spark, duck(sf), name, QUERIES[name], SQL[name], sf)
    assert same, detail
