"""Guards for the physical-plan properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def plan(spark, name: str) -> str:
    df = E.queries()[name](spark, SF001)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_top_k_limits_before_the_shuffle(spark):
    p = plan(spark, "top_tags")
    assert "WindowGroupLimit" in p and ", Partial" in p


def test_high_water_mark_reaches_the_scan(spark):
    p = plan(spark, "high_water_filter")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,", p)


def test_seed_lookup_is_broadcast(spark):
    p = plan(spark, "seed_lookup")
    assert "BroadcastHashJoin LeftOuter" in p and "SortMergeJoin" not in p


def test_grains_share_one_scan(spark):
    p = plan(spark, "metric_by_grain")
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_scans_read_only_used_columns(spark):
    p = plan(spark, "metric_average")
    schemas = re.findall(r"ReadSchema: (struct<.*>)", p)
    assert schemas == ["struct<value:double>"]


@pytest.mark.parametrize("name", ["incremental_ratings", "payload_upsert"])
def test_upsert_never_shuffles_the_target_rows(spark, name):
    # Every exchange below the final union carries batch-side data (dedupe, key
    # probe): no Exchange hashes the target on its full row set, i.e. the outer
    # join of target and batch is a broadcast join at this size.
    p = plan(spark, name)
    assert "BroadcastHashJoin LeftOuter" in p
    assert "SortMergeJoin LeftOuter" not in p


def test_checks_end_in_one_grouped_count(spark):
    p = plan(spark, "check_report")
    top = p.split("\n")[1:6]
    # the report is one aggregate over the union of the check list and the failure
    # markers: no join at the top of the plan
    assert any("Aggregate" in line for line in top)
    assert "HashAggregate" in p
    assert not any("Join" in line for line in top)


@pytest.mark.parametrize("name", sorted(E.BASE_QUERIES))
def test_no_python_in_the_plan(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"
