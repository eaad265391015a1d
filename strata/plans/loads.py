"""Keyed merges and incremental fact loads against the versioned store.

A keyed table is stored in buckets of its key. A merge finds the buckets that hold a key of the batch (the table's key
columns are probed with the batch's keys), rewrites those, and adds the batch's other rows as new files to
their buckets: what a run writes grows with the batch and the buckets it hits, not with the table.

The high-water mark of a fact is kept as metadata of each version, in epoch microseconds, so it means the same
whatever the time zone of the driver or of the next run. A run reads it in O(1), filters the raw scan with it
(pushed to Parquet), and takes the new one from the rows as they are written (an ``Observation``): no job of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.joins import estimated_size_bytes
from strata.operators.upsert import dedupe_latest, high_water_filter, high_water_mark, mark_value, upsert
from strata.session import storage_root
from strata.sources.storage import BUCKET, TableStore

MARK = "high_water_mark_micros"
#: Key buckets of a new table: at least, per estimated bytes of its first load, and at most; and the folders a bucket may
#: gather before a merge rewrites it.
BUCKETS, BUCKET_BYTES, MOST_BUCKETS = 256, 1 << 30, 1 << 16
MAX_FOLDERS = 8


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_number(first_load: DataFrame) -> int:
    """Buckets of a new table, from Catalyst's estimate of its first load (a merge rewrites whole buckets, so they stay small)."""
    size = estimated_size_bytes(first_load) or 0
    return BUCKETS if size >= 1 << 62 else min(max(BUCKETS, -(-size // BUCKET_BYTES)), MOST_BUCKETS)


def merge_buckets(
    store: TableStore,
    layer: str,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    buckets: int | None = None,
    observed: Callable[[DataFrame], Column] | None = None,
    properties: Callable[[object], dict] | None = None,
) -> DataFrame:
    """Merge ``batch`` into a bucketed table; the stored new version (the present one if the batch is empty).

    ``merge(target, batch)`` gets the rows of the touched buckets (None on a first run) and the whole batch, and returns
    the rows to write. ``properties`` gets the value of the aggregate ``observed`` over the written rows."""
    first = store.current_version(layer, name) is None
    held = {} if first else store.properties(layer, name)
    buckets = int(held.get("buckets") or buckets or bucket_number(batch))
    empty = False
    if first:
        replaced, target, empty = set(), None, batch.isEmpty()
    else:
        storage_root(store.spark)  # in tests, names the checkpoint folder
        batch = batch.checkpoint()  # read twice: for the buckets it touches and for the merge
        table = store.read(layer, name)
        if batch.isEmpty():
            return table
        same = [F.col(f"__k_{k}") == F.col(k) for k in keys]
        probe = batch.select(*[F.col(k).cast(table.schema[k].dataType).alias(f"__k_{k}") for k in keys]).distinct()
        hits = table.select(*keys).join(probe, same, "left_semi").select(bucket_of(keys, buckets).alias("b")).distinct()
        parts = store.parts(layer, name)
        replaced = {str(r["b"]) for r in hits.collect()}  # at most one row per bucket
        replaced |= {b for b, folders in parts.items() if len(folders) >= MAX_FOLDERS}
        target = store.read_parts(layer, name, {b: f for b, f in parts.items() if b in replaced}, table.schema)
    merged = merge(target, batch)
    out = merged.withColumn(BUCKET, bucket_of(keys, buckets))
    watch = Observation()
    out = out.observe(watch, (observed(merged) if observed else F.count(F.lit(1))).alias("value"))
    kept = {k: v for k, v in held.items() if k not in ("parts", "schema")} | {"buckets": buckets}
    return store.write_buckets(
        # Rows of a bucket meet, so a small one gets one file; AQE splits a large one over tasks of the advisory size, and a file each.
        out.hint("rebalance", BUCKET), layer, name, replaced,
        # Over an empty relation the plan observes nothing.
        lambda: kept | (properties(None if empty else watch.get["value"]) if properties else {}),
    )


def effects(
    part: DataFrame | None, batch: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order_cols: Sequence[str] = ()
) -> tuple[DataFrame | None, DataFrame]:
    """What merging ``batch`` into ``part`` by ``keys`` does: the stored rows it replaces, each with the columns that replace it under
    ``new_<column>`` (None without ``part``), and the rows it adds."""
    if part is None:
        return None, batch
    source = dedupe_latest(batch, keys, order_cols) if on_duplicate == "latest" else batch
    source = source.select(*part.columns)
    new = source.select(*[F.col(c).alias(f"new_{c}") for c in source.columns])
    same = [F.col(k) == F.col(f"new_{k}") for k in keys]
    replaced = part.join(new, same)
    known = replaced.select(*[F.col(k).alias(f"known_{k}") for k in keys]).distinct()
    return replaced, source.join(known, [F.col(k) == F.col(f"known_{k}") for k in keys], "left_anti")


def stored_mark(store: TableStore, layer: str, name: str, ts_col: str, target: DataFrame | None):
    """The fact's high-water mark: from version metadata when recorded."""
    if target is None:
        return None
    props = store.properties(layer, name)
    return props[MARK] if MARK in props else high_water_mark(target, ts_col)


def raw_after(raw: DataFrame, mark: int | None, raw_ts_col: str = "timestamp") -> DataFrame:
    """Raw rows whose epoch-second timestamp lies after ``mark`` (epoch microseconds): a plain
    comparison on the stored column, so it reaches the Parquet scan."""
    if mark is None:
        return raw
    return raw.where(F.col(raw_ts_col) > F.lit(mark // 1_000_000))


def load_incremental_fact(
    store: TableStore,
    layer: str,
    name: str,
    raw: DataFrame,
    to_rows: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    ts_col: str,
    on_duplicate: str = "error",
    order_col: str | None = None,
    raw_ts_col: str = "timestamp",
    buckets: int | None = None,
    changed: Callable[[DataFrame | None, DataFrame], None] | None = None,
) -> DataFrame:
    """One incremental run of a stored fact; returns the stored new version.

    The rules are those of :func:`strata.operators.upsert.incremental_load`: everything on a first run or over
    an empty fact, nothing over a fact without a timestamp, else the rows above the mark, upserted by key.
    ``changed(part, batch)`` is told what a merge is about to do: ``part`` holds the stored rows of the touched buckets (None if the
    batch is stored as it is), ``batch`` the rows that are upserted into them. A run that stores nothing does not call it."""
    target = store.read(layer, name)
    mark = stored_mark(store, layer, name, ts_col, target)
    rows = to_rows(raw_after(raw, mark, raw_ts_col))
    carry = [order_col] if order_col else []
    if mark is not None:
        rows = high_water_filter(rows, ts_col, mark)
    elif target is not None and not target.isEmpty():
        return target

    def merge(part: DataFrame | None, batch: DataFrame) -> DataFrame:
        if changed:
            changed(None if mark is None else part, batch)
        if mark is None:
            return batch.drop(*carry)
        return upsert(part, batch, keys, on_duplicate=on_duplicate, order_cols=[ts_col, *carry])

    def new_mark(value) -> dict:
        return {MARK: max((m for m in (mark, value) if m is not None), default=None)}

    return merge_buckets(
        store, layer, name, rows, keys, merge, buckets, observed=lambda df: mark_value(df, ts_col), properties=new_mark
    )
