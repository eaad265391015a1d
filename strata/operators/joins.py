"""Joins against lookup tables with a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest estimated size (bytes) of a lookup side that is broadcast on request. The estimate comes from compressed
# files, so the rows may take several times as much; beyond the bound the choice is AQE's.
DEFAULT_BROADCAST_BYTES = 2 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job is run). None when unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:
        return None
    # py4j hands a Scala BigInt back as a Python int; keep the text path for others.
    return size if isinstance(size, int) else int(str(size.toString()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its estimated size is within ``max_bytes``.

    Beyond the bound (or when no estimate exists) the frame is returned unchanged
    and the planner falls back to a shuffled join; AQE may still convert it to a
    broadcast from runtime statistics.
    """
    size = estimated_size_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join ``left`` to a lookup table, broadcasting the lookup when it is
    provably small. Plain ``=`` semantics: NULL keys never match."""
    return left.join(broadcast_if_small(lookup, max_broadcast_bytes), on=on, how=how)


def skew_safe_left_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """``left ⟕ right`` on equal keys, written so that a hot key on either side can
    be split.

    AQE splits skewed partitions only on the preserved side of an outer join, so a
    key holding a third of ``right`` (a fan-out) would land in one task. Here the
    matches come from an inner join (AQE may split either side) and the unmatched
    left rows from an anti join against ``right``'s distinct keys (combined
    map-side, unique per key); right-hand columns are NULL for those rows, as in a
    left join. NULL keys never match.
    """
    keys = [on] if isinstance(on, str) else list(on)
    right_cols = [c for c in right.columns if c not in keys]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # Both joins start from the same rows and columns of ``left``, so they share one exchange of it.
    keyed, held = left.where(known), right.where(known)
    matched = keyed.join(held, on=keys, how="inner").select(*left.columns, *right_cols)
    types = dict(right.dtypes)
    none = [F.lit(None).cast(types[c]).alias(c) for c in right_cols]
    unmatched = keyed.join(held.select(*keys).distinct(), on=keys, how="left_anti").select(*left.columns, *none)
    return matched.unionByName(unmatched).unionByName(left.where(~known).select(*left.columns, *none))
