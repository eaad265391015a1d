"""Rating summaries from a histogram that each load keeps.

The histogram has one row per (movie, rating value) of the stored ratings fact: how many rows have it. Mean, count, least and largest
rating of a movie are read off it. A load changes it by what it replaces (minus one) and what it brings (plus
one), so a run reads the batch and the buckets the batch touches, never the fact; minima and maxima, which cannot be
updated from a retracted value alone, come out right too.

The histogram is stored beside the fact with the fact's version it belongs to. If a run died between the two writes, the versions
differ and the next run rebuilds it from the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.loads import effects
from strata.plans.project import scratch_keeper
from strata.sources.storage import TableStore

OF_VERSION = "of_version"
NAME = "rating_histogram"


def histogram(fact: DataFrame) -> DataFrame:
    """``(movie_id, rating, n)`` of all rows. Partial counts first: a movie with a third of all ratings moves a row per value and task."""
    return fact.groupBy("movie_id", "rating").agg(F.count(F.lit(1)).alias("n"))


def changes(
    part: DataFrame | None, batch: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order_cols: Sequence[str] = ()
) -> DataFrame:
    """What a merge changes: ``(movie_id, rating, n)`` with n negative for values that go."""
    replaced, added = effects(part, batch, keys, on_duplicate, order_cols)
    rows = added.select("movie_id", "rating", F.lit(1).cast("bigint").alias("n"))
    if replaced is not None:
        old = F.struct("movie_id", "rating", F.lit(-1).cast("bigint").alias("n"))
        new = F.struct(F.col("new_movie_id").alias("movie_id"), F.col("new_rating").alias("rating"), F.lit(1).cast("bigint").alias("n"))
        rows = rows.unionByName(replaced.select(F.explode(F.array(old, new)).alias("x")).select("x.*"))
    return _added_up(rows)


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("movie_id", "rating").agg(F.sum("n").alias("n")).where("n <> 0")


def summary(counts: DataFrame) -> DataFrame:
    """Per movie ``avg_rating, rating_count, min_rating, max_rating``; NULL ratings count for none of them."""
    n = F.when(F.col("rating").isNotNull(), F.col("n")).otherwise(0)
    total = F.sum(n)
    return counts.groupBy("movie_id").agg(
        F.when(total > 0, F.sum(F.col("rating") * F.col("n")) / total).alias("avg_rating"),
        total.cast("bigint").alias("rating_count"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


class KeptHistogram:
    """Follows one load of a stored fact: made before the load, told of its merge (``changed``), stored after it (``store``)."""

    def __init__(self, store: TableStore, layer: str, fact: str, keys: Sequence[str], on_duplicate: str, order_cols: Sequence[str]):
        self._store, self._layer, self._fact = store, layer, fact
        self._merge = (keys, on_duplicate, order_cols)
        self._before = store.current_version(layer, fact)
        self._delta: DataFrame | None = None

    def changed(self, part: DataFrame | None, batch: DataFrame) -> None:
        if part is not None:
            # Written now: the fact's files that it reads may be retired with the merge.
            self._delta = scratch_keeper(self._store.spark)(changes(part, batch, *self._merge))

    def store(self) -> DataFrame | None:
        """The histogram of the fact's current version; None while the fact is not stored."""
        now, held = self._store.current_version(self._layer, self._fact), self._store.read(self._layer, NAME)
        of = self._store.properties(self._layer, NAME).get(OF_VERSION)
        if now is None or (held is not None and of == now):
            return held
        if held is not None and self._delta is not None and of == self._before:
            counts = _added_up(held.unionByName(self._delta))
        else:
            counts = histogram(self._store.read(self._layer, self._fact))
        return self._store.write(counts, self._layer, NAME, properties={OF_VERSION: now})
