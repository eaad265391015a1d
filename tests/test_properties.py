"""Randomised checks of the upsert and SCD2 operators against pure-Python models
of the loop semantics (one MERGE per row, in arrival order; one snapshot per run)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.scd2 import scd2_apply
from strata.operators.upsert import upsert

KEYS = st.one_of(st.none(), st.integers(0, 4))
VALS = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
SCHEMA = "k bigint, v string, o bigint"
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def merge_loop(target, source):
    """One MERGE per source row in arrival order (column o): matched rows (plain =,
    NULL never matches) take the row's values, otherwise the row is inserted."""
    table = [list(r) for r in target]
    for k, v, o in sorted(source, key=lambda r: r[2]):
        hits = [r for r in table if k is not None and r[0] == k]
        if hits:
            for r in hits:
                r[1], r[2] = v, o
        else:
            table.append([k, v, o])
    return sorted(map(tuple, table), key=repr)


@SETTINGS
@given(
    target=st.lists(st.tuples(KEYS, VALS), max_size=6),
    source=st.lists(st.tuples(KEYS, VALS), max_size=8),
)
def test_upsert_latest_equals_merge_loop(spark, target, source):
    t = [(k, v, -1) for k, v in target]
    s = [(k, v, i) for i, (k, v) in enumerate(source)]
    got = upsert(
        spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA), ["k"],
        on_duplicate="latest", order_cols=["o"],
    )
    assert sorted(map(tuple, got.select("k", "v", "o").collect()), key=repr) == merge_loop(t, s)


def snapshot_model(history, source, as_of):
    """Check strategy on column v, key k (unique, non-NULL in the source)."""
    out = [dict(r) for r in history if r["valid_to"] is not None]
    current = {r["k"]: dict(r) for r in history if r["valid_to"] is None}
    src = {k: v for k, v in source}
    for k, r in current.items():
        if k in src and src[k] != r["v"]:
            r["valid_to"] = as_of
            out.append({"k": k, "v": src[k], "valid_from": as_of, "valid_to": None})
        out.append(r)
    for k, v in src.items():
        if k not in current:
            out.append({"k": k, "v": v, "valid_from": as_of, "valid_to": None})
    return out


def _norm(rows):
    return sorted(((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in rows), key=repr)


@SETTINGS
@given(runs=st.lists(st.dictionaries(st.integers(0, 5), VALS, max_size=5), min_size=1, max_size=3))
def test_scd2_equals_snapshot_model(spark, runs):
    history_df, model = None, []
    for day, snap in enumerate(runs):
        as_of = dt.datetime(2024, 1, 1 + day)
        src = spark.createDataFrame(sorted(snap.items()), "k bigint, v string")
        history_df = scd2_apply(history_df, src, "k", ["v"], as_of)
        model = snapshot_model(model, sorted(snap.items()), as_of)
    got = [r.asDict() for r in history_df.select("k", "v", "valid_from", "valid_to").collect()]
    assert _norm(got) == _norm(model)
