"""Every registered query against its DuckDB twin at sf0.01 (the correctness gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(E.BASE_QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql()[name]
    r = compare(spark, con, name, E.queries()[name], sql, SF01)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["match"], r
