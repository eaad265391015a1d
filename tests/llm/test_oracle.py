"""Every training-data query with a SQL twin against it at sf0.01, and schemas of all of them."""

import pytest

from strata.llm import registry
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, registry.QUERIES[name], registry.ORACLE_SQL[name], SF01)
    assert r["match"], r


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op5_secret_scan"])
def test_native_queries_plan_no_python(spark, name):
    df = registry.QUERIES[name](spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
