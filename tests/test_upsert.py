import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.upsert import (
    DuplicateKeyError,
    dedupe_latest,
    high_water_filter,
    high_water_mark,
    incremental_load,
    upsert,
)

SCHEMA = "k bigint, v string, ts bigint"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_upsert_updates_matched_inserts_new(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], SCHEMA)
    source = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (None, "m", 2)], SCHEMA)
    out = upsert(target, source, ["k"])
    assert rows(out, "k", "v", "ts") == [(1, "a", 1), (2, "B", 2), (3, "c", 2), (None, "m", 2), (None, "n", 1)]


def test_upsert_overwrites_with_null_values(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(1, None, 5)], SCHEMA)
    assert rows(upsert(target, source, ["k"]), "k", "v", "ts") == [(1, None, 5)]


def test_upsert_updates_each_duplicate_target_row(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "a2", 1)], SCHEMA)
    source = spark.createDataFrame([(1, "z", 9)], SCHEMA)
    assert rows(upsert(target, source, ["k"]), "k", "v") == [(1, "z"), (1, "z")]


def test_upsert_duplicate_matched_source_keys_raise(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(1, "x", 2), (1, "y", 3)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, ["k"])


def test_upsert_unmatched_duplicates_all_inserted(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(5, "x", 2), (5, "y", 3)], SCHEMA)
    assert rows(upsert(target, source, ["k"]), "k", "v") == [(1, "a"), (5, "x"), (5, "y")]


def test_upsert_latest_keeps_last_by_order(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(1, "x", 3), (1, "y", 2), (4, "p", 1), (4, "q", 7)], SCHEMA)
    out = upsert(target, source, ["k"], on_duplicate="latest", order_cols=["ts"])
    assert rows(out, "k", "v", "ts") == [(1, "x", 3), (4, "q", 7)]


def test_dedupe_latest_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (1, "c", 1), (1, "d", 2)], SCHEMA)
    assert rows(dedupe_latest(df, ["k"], ["ts"]), "k", "v") == [(1, "d"), (None, "a"), (None, "b")]


def test_upsert_composite_key_and_insert_values(spark):
    target = spark.createDataFrame([(1, 1, "a", None)], "a bigint, b bigint, v string, at timestamp")
    source = spark.createDataFrame([(1, 1, "z"), (1, 2, "n")], "a bigint, b bigint, v string")
    at = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    out = upsert(target, source, ["a", "b"], insert_values={"at": at}, update_values={"at": at},
                 update_cols=["v", "at"])
    got = rows(out, "a", "b", "v", "at")
    assert got == [(1, 1, "z", dt.datetime(2024, 1, 1)), (1, 2, "n", dt.datetime(2024, 1, 1))]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    source = spark.createDataFrame([(2, "B", 2), (3, "c", 2)], SCHEMA)
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert rows(once, "k", "v", "ts") == rows(twice, "k", "v", "ts")


def test_high_water_strict_and_late_rows(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], SCHEMA)
    source = spark.createDataFrame([(3, "late", 15), (4, "equal", 20), (5, "new", 21), (6, "nullts", None)], SCHEMA)
    mark = high_water_mark(target, "ts")
    assert mark == 20
    assert rows(high_water_filter(source, "ts", mark), "k") == [(5,)]
    out = incremental_load(target, source, ["k"], "ts")
    assert rows(out, "k", "v") == [(1, "a"), (2, "b"), (5, "new")]


def test_incremental_first_run_loads_everything(spark):
    source = spark.createDataFrame([(1, "a", None), (1, "a", 3)], SCHEMA)
    assert incremental_load(None, source, ["k"], "ts").count() == 2


def test_incremental_empty_target_is_first_run(spark):
    empty = spark.createDataFrame([], SCHEMA)
    source = spark.createDataFrame([(1, "a", 5)], SCHEMA)
    assert rows(incremental_load(empty, source, ["k"], "ts"), "k") == [(1,)]


def test_incremental_rerun_is_noop(spark):
    target = spark.createDataFrame([(1, "a", 10)], SCHEMA)
    source = spark.createDataFrame([(1, "b", 11), (2, "c", 12)], SCHEMA)
    once = incremental_load(target, source, ["k"], "ts")
    twice = incremental_load(once, source, ["k"], "ts")
    assert rows(once, "k", "v", "ts") == rows(twice, "k", "v", "ts") == [(1, "b", 11), (2, "c", 12)]


def test_incremental_all_null_timestamps_takes_nothing(spark):
    target = spark.createDataFrame([(1, "a", None)], SCHEMA)
    source = spark.createDataFrame([(2, "b", 5)], SCHEMA)
    assert rows(incremental_load(target, source, ["k"], "ts"), "k", "v") == [(1, "a")]


@pytest.mark.parametrize("bound", [-1, 1 << 40])
def test_both_plan_shapes_of_a_merge(spark, bound):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 1), (None, "d", 1)], "k int, v string, at int")
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, None, 1), (None, "z", 1)], "k int, v string, o int")
    out = upsert(
        target, source, ["k"], update_cols=["v", "at"], on_duplicate="latest", order_cols=["o"],
        insert_values={"at": F.lit(7)}, update_values={"at": F.lit(9)}, large_batch_bytes=bound,
    )
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, "y", 9), (1, "y", 9), (2, "c", 1), (None, "d", 1), (3, None, 7), (None, "z", 7)], key=repr)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert ("FullOuter" in plan) == (bound == -1)
