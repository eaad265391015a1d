"""Orphans of a fact kept from run to run by a two-sided delta anti join.

The kept state is the number of fact rows per key that the dimension lacks. A run looks at what changed on either side: new fact rows
against the dimension, and keys that the dimension lost against the stored facts; kept orphans whose key has come (back) drop out.
The stored facts are read, key column only, when keys were withdrawn and not otherwise. The state equals the full check's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lacking(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key the dimension lacks (a NULL key is an orphan)."""
    known = dim.where(F.col(key).isNotNull()).select(F.col(key).alias("__known")).distinct()
    return rows.join(known, F.col(key) == F.col("__known"), "left_anti")


def _counted(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def orphans(fact: DataFrame, dim: DataFrame, key: str = "movie_id") -> DataFrame:
    """``(key, n)`` of all orphans: the full check. Keys are counted before the join, so a hot key is one row in it."""
    return _lacking(_counted(fact, key), dim, key)


def orphans_after(
    held: DataFrame, added: DataFrame, stored: DataFrame, dim_before: DataFrame, dim: DataFrame, key: str = "movie_id"
) -> DataFrame:
    """The orphans after a run: ``held`` before it, ``added`` fact rows, the ``stored`` ones before it, and both dimensions."""
    # Orphans among the stored rows of keys that the dimension had before are in ``held`` already only if it lacked them.
    withdrawn = _lacking(dim_before.where(F.col(key).isNotNull()).select(key).distinct(), dim, key).withColumnRenamed(key, "__gone")
    lost = _counted(stored.select(key).join(withdrawn, F.col(key) == F.col("__gone"), "left_semi"), key)
    parts = _lacking(held, dim, key).unionByName(orphans(added, dim, key)).unionByName(lost)
    return parts.groupBy(key).agg(F.sum("n").alias("n"))
