"""Keyed upsert, high-water mark and incremental keyed loads.

MERGE semantics re-expressed as set operations (no ACID table format needed):

* target rows whose key matches a source row take the source's values for the
  update columns (NULLs included; decided by a match marker, never by value);
* source rows whose key matches no target row are inserted;
* keys compare with plain ``=``: a NULL key never matches, so NULL-keyed source rows
  are always inserted and NULL-keyed target rows are never updated;
* duplicates already in the target are each updated, never collapsed.

Plan shape, small batch: one left join of the target to the batch (unique per key on that
side), plus the inserts: the batch minus the batch keys the target holds (found by
probing the target's key columns with the batch's distinct keys). When the batch is
small, AQE broadcasts it and the target is only scanned and written, never
shuffled. In every join the non-preserved side is unique per key and the
preserved side is the one AQE can split when a key is hot. The batch is never
collected.

Plan shape, large batch (estimated above ``LARGE_BATCH_BYTES``, where the target would be shuffled for both joins): one
full outer join of the target with the batch, unique per key, gives updates and inserts at once and shuffles either
side once. Both shapes give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.operators.joins import estimated_size_bytes

#: Estimated size of a batch above which one full outer join replaces the left join and the probe.
LARGE_BATCH_BYTES = 256 * 1024 * 1024

_MATCH = "__strata_matched"
_UNSET = object()
_SRC = "__s_"


class DuplicateKeyError(ValueError):
    """A target row would be matched by more than one source row."""


def _any_null(cols: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(f"{prefix}{c}").isNull()
    return cond


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep, per non-NULL key, the row that is last by ``order_cols``.

    Rows with a NULL in any key column are kept as they are: they never match, so
    each one would be inserted by its own MERGE. ``max_by`` is a declarative
    aggregate: it is combined map-side, so a key holding a third of the batch
    still moves one row per task through the shuffle.
    """
    if not order_cols:
        raise ValueError("dedupe_latest needs order columns to decide which row is latest")
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    null_keyed = df.where(_any_null(keys))
    keyed = df.where(~_any_null(keys))
    if not others:
        return keyed.dropDuplicates(keys).unionByName(null_keyed)
    payload = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_cols])
    latest = keyed.groupBy(*keys).agg(F.max_by(payload, order).alias("__latest"))
    latest = latest.select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in others])
    return latest.select(*df.columns).unionByName(null_keyed)


def _eq(keys: Sequence[str], left_prefix: str, right_prefix: str) -> Column:
    cond = None
    for k in keys:
        term = F.col(left_prefix + k) == F.col(right_prefix + k)
        cond = term if cond is None else cond & term
    return cond


def _keys_in_target(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``keys_df`` (distinct, non-NULL) that occur in ``target``.

    The target's key columns are semi-joined against the (small) key set, so the
    target is only scanned, never shuffled, when the key set can be broadcast; the
    result has at most as many rows as ``keys_df``.
    """
    probe = keys_df.select(*[F.col(k).alias("__p_" + k) for k in keys])
    hits = target.select(*keys).join(probe, _eq(keys, "", "__p_"), "left_semi")
    return hits.distinct()


def matched_duplicate_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL source keys that occur more than once and also exist in the target."""
    keys = list(keys)
    dup = source.where(~_any_null(keys)).groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    return _keys_in_target(target, dup, keys)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order_cols: Sequence[str] = (),
    insert_values: dict[str, Column] | None = None,
    update_values: dict[str, Column] | None = None,
    large_batch_bytes: int = LARGE_BATCH_BYTES,
) -> DataFrame:
    """Apply ``source`` to ``target`` by ``keys``; returns the new table (target schema).

    update_cols: target columns overwritten from the source on a match (default:
        every non-key target column the source has).
    on_duplicate: "error" raises when a target row would be matched by several
        source rows (unmatched duplicates are all inserted, as a MERGE does);
        "latest" keeps the last source row per key by ``order_cols`` first.
    insert_values / update_values: expressions for target columns the source does
        not carry (e.g. a load timestamp), used on insert / on update.
    """
    keys = list(keys)
    insert_values = dict(insert_values or {})
    update_values = dict(update_values or {})
    missing = [k for k in keys if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"key columns {missing} must exist in target and source")

    if on_duplicate == "latest":
        source = dedupe_latest(source, keys, order_cols)
        update_side = source
    elif on_duplicate == "error":
        if matched_duplicate_keys(target, source, keys).limit(1).count() > 0:
            raise DuplicateKeyError(f"source has duplicate keys {keys} that match target rows")
        # Keys still duplicated now match no target row, so collapsing them cannot
        # change an update; it keeps the join's batch side unique per key even when
        # one new key holds a third of the batch (all copies are still inserted).
        update_side = source.dropDuplicates(keys)
    else:
        raise ValueError("on_duplicate must be 'error' or 'latest'")

    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys and c in source.columns]
    update_cols = list(update_cols)
    for c in update_cols:
        if c not in source.columns and c not in update_values:
            raise ValueError(f"update column {c!r} is neither in the source nor in update_values")

    tgt_types = dict(target.dtypes)

    def inserted(df: DataFrame, prefix: str = "") -> DataFrame:
        cols = []
        for c in target.columns:
            if c in source.columns:
                value = F.col(prefix + c)
            else:
                value = insert_values.get(c, F.lit(None))
            cols.append(value.cast(tgt_types[c]).alias(c))
        return df.select(*cols)

    carried = [c for c in update_cols if c in source.columns]
    size = estimated_size_bytes(source) or 0
    if size >= 1 << 62:  # Catalyst's mark of an unknown size: leave the choice of joins to AQE
        size = 0
    if on_duplicate == "latest" and size > large_batch_bytes:
        known = ~_any_null(keys)
        batch = source.where(known).select(*[F.col(c).alias(_SRC + c) for c in source.columns], F.lit(True).alias(_MATCH))
        both = target.where(known).withColumn("__strata_held", F.lit(True)).join(batch, _eq(keys, "", _SRC), "full_outer")
        held, matched = F.col("__strata_held").isNotNull(), F.col(_MATCH).isNotNull()
        cols = []
        for c in target.columns:
            new = F.col(_SRC + c) if c in carried else update_values.get(c, F.col(c)) if c in update_cols else F.col(c)
            fresh = F.col(_SRC + c) if c in source.columns else insert_values.get(c, F.lit(None))
            value = F.when(~held, fresh.cast(tgt_types[c])).when(matched, new.cast(tgt_types[c])).otherwise(F.col(c))
            cols.append(value.alias(c))
        # NULL keys match nothing: such rows stay out of the join, where they would meet in one task.
        return both.select(*cols).unionByName(target.where(_any_null(keys))).unionByName(inserted(source.where(_any_null(keys))))

    # 1. target ⟕ batch: matched rows take the batch values.
    batch = update_side.select(
        *[F.col(k).alias(_SRC + k) for k in keys],
        *[F.col(c).alias(_SRC + c) for c in carried],
        F.lit(True).alias(_MATCH),
    )
    joined = target.join(batch, _eq(keys, "", _SRC), "left")
    matched = F.col(_MATCH).isNotNull()
    updated_cols = []
    for c in target.columns:
        if c in carried:
            value = F.when(matched, F.col(_SRC + c).cast(tgt_types[c])).otherwise(F.col(c))
        elif c in update_values:
            value = F.when(matched, update_values[c].cast(tgt_types[c])).otherwise(F.col(c))
        else:
            value = F.col(c)
        updated_cols.append(value.alias(c))
    updated = joined.select(*updated_cols)

    # 2. inserts: batch rows whose key the target does not hold (NULL keys never
    #    match, so NULL-keyed rows are always inserted).
    inserts = _anti_by_eq(source, target, keys, source_unique=on_duplicate == "latest")
    return updated.unionByName(inserted(inserts))


def _anti_by_eq(source: DataFrame, target: DataFrame, keys: Sequence[str], source_unique: bool = False) -> DataFrame:
    """``source`` rows with no target row equal on every key (plain ``=``).

    Computed against the batch's keys that the target holds (at most the batch's
    distinct keys), not against all target keys: the large side is scanned for its
    key columns only and probed against the batch keys, so no run shuffles the
    whole target. NULL keys never match, so NULL-keyed rows are kept.
    """
    batch_keys = source.where(~_any_null(keys)).select(*keys)
    if not source_unique:
        batch_keys = batch_keys.distinct()
    matched = _keys_in_target(target, batch_keys, keys).select(*[F.col(k).alias("__t_" + k) for k in keys])
    return source.join(matched, _eq(keys, "", "__t_"), "left_anti")


def mark_value(df: DataFrame, ts_col: str) -> Column:
    """``max(ts_col)`` as a mark: epoch microseconds for a timestamp, which mean the same in every time zone of
    the driver, the session and the next run; the value itself for other types."""
    highest = F.max(ts_col)
    return F.unix_micros(highest) if isinstance(df.schema[ts_col].dataType, TimestampType) else highest


def high_water_mark(target: DataFrame, ts_col: str):
    """``max(ts_col)`` of the stored table (one global aggregate, one value back)."""
    return target.agg(mark_value(target, ts_col).alias("mark")).first()["mark"]


def mark_column(mark: int) -> Column:
    """The timestamp of a mark in epoch microseconds, as a literal."""
    return F.timestamp_micros(F.lit(mark))


def high_water_filter(source: DataFrame, ts_col: str, mark) -> DataFrame:
    """Rows strictly newer than ``mark``. The mark is a literal, so the predicate
    reaches the Parquet scan of the source as a pushed filter."""
    is_time = isinstance(source.schema[ts_col].dataType, TimestampType)
    return source.where(F.col(ts_col) > (mark_column(mark) if is_time else F.lit(mark)))


def incremental_load(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    on_duplicate: str = "error",
    order_cols: Sequence[str] = (),
    mark=_UNSET,
) -> DataFrame:
    """Keyed incremental load with a high-water mark.

    No stored table, or a stored but empty one: every source row, no de-duplication
    (first run; an empty target is treated as a first run so it does not stay empty
    for ever). A stored table whose timestamps are all NULL has a NULL mark and
    takes nothing. Otherwise only rows with ``ts_col`` strictly above ``max(ts_col)``
    of the target are upserted by ``keys``: late rows (at or below the mark) are
    never loaded, and a NULL timestamp loads only on the first run.
    Columns of the source that are not in the target (e.g. order columns) are
    dropped from the result. ``mark`` may be passed when the caller already read it
    (e.g. to push it into the source scan); it must be ``max(ts_col)`` of target.
    """
    if mark is _UNSET:
        mark = None if target is None else high_water_mark(target, ts_col)
    if mark is None:
        if target is not None and not target.isEmpty():
            # Rows exist but none has a timestamp: nothing is above a NULL mark.
            return target
        out_cols = [c for c in source.columns if c not in order_cols or c == ts_col]
        return source.select(*out_cols)
    batch = high_water_filter(source, ts_col, mark)
    return upsert(target, batch, keys, on_duplicate=on_duplicate, order_cols=order_cols)
