"""Checks of an incrementally loaded fact, kept by its loads.

The state is the number of failures per check, stored beside the fact with the fact's version it belongs to. A load changes it by what
it does: row-level checks by the rows that come and go, uniqueness checks by the keys that come, each counted before and after in
the buckets that these keys fall into. So a run reads the batch and the buckets it touches, and the report equals that of
the full suite. On a first run, and when a run died between the two writes, the fact is checked whole.

Only uniqueness over the fact's keys, or over a column made of them alone (``surrogates``), can be kept: equal values are
then in one bucket, and replacing a row does not change them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import ROW_LEVEL, UNIQUENESS, Check, failing_condition, run_checks, with_status
from strata.plans.loads import bucket_of, effects
from strata.plans.project import scratch_keeper
from strata.sources.storage import TableStore

OF_VERSION = "of_version"


def _same(columns: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(prefix + c))
    return same


def newly_repeated(check: Check, added: DataFrame, stored: DataFrame) -> DataFrame:
    """How many more values of the check occur more than once when ``added`` joins ``stored``: one row, ``n``."""
    columns = list(check.columns)
    if check.kind == "unique":  # NULLs take no part
        added, stored = (df.where(F.col(columns[0]).isNotNull()) for df in (added, stored))
    come = added.groupBy(*columns).agg(F.count(F.lit(1)).alias("come"))
    touched = come.select(*[F.col(c).alias(f"t_{c}") for c in columns])
    before = stored.select(*columns).join(touched, _same(columns, "t_"), "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("before"))
    before = before.select(*[F.col(c).alias(f"b_{c}") for c in columns], "before")
    both = come.join(before, _same(columns, "b_"), "left").withColumn("before", F.coalesce("before", F.lit(0)))
    return both.agg(F.count_if((F.col("before") <= 1) & (F.col("before") + F.col("come") > 1)).alias("n"))


class KeptChecks:
    """Follows one load of a stored fact: made before the load, told of its merge (``changed``), stored after it (``store``)."""

    def __init__(
        self, store: TableStore, layer: str, fact: str, checks: Sequence[Check], keys: Sequence[str], surrogates: Sequence[str],
        on_duplicate: str, order_cols: Sequence[str],
    ):
        for c in checks:
            if c.kind not in ROW_LEVEL and (c.kind not in UNIQUENESS or (set(c.columns) != set(keys) and not set(c.columns) <= set(surrogates))):
                raise ValueError(f"{c.check_name} cannot be kept from load to load")
        self._store, self._layer, self._fact, self._name = store, layer, fact, f"{fact}_checks"
        self._checks, self._keys = list(checks), list(keys)
        self._merge = (keys, on_duplicate, order_cols)
        self._before = store.current_version(layer, fact)
        self._delta: dict[str, int] | None = None

    def changed(self, part: DataFrame | None, batch: DataFrame) -> None:
        if part is None:
            return
        keep = scratch_keeper(self._store.spark)
        replaced, added = effects(part, batch, *self._merge)
        added, replaced = keep(added), keep(replaced)
        new = replaced.select(*[F.col(f"new_{c}").alias(c) for c in part.columns])
        signed = added.withColumn("sign", F.lit(1)).unionByName(new.withColumn("sign", F.lit(1)))
        signed = signed.unionByName(replaced.select(*part.columns).withColumn("sign", F.lit(-1)))
        rules = [c for c in self._checks if c.kind in ROW_LEVEL]
        fails = [F.coalesce(F.sum(F.when(failing_condition(c), F.col("sign"))), F.lit(0)).alias(f"n{i}") for i, c in enumerate(rules)]
        delta = {c.check_name: n for c, n in zip(rules, signed.agg(*fails).first() if rules else (), strict=True)}
        unique = [c for c in self._checks if c.kind in UNIQUENESS]
        if unique:
            parts = self._store.parts(self._layer, self._fact)
            buckets = int(self._store.properties(self._layer, self._fact)["buckets"])
            hit = added.select(bucket_of(self._keys, buckets).alias("b")).distinct().collect()  # at most one row per bucket
            near = {str(r["b"]): parts[str(r["b"])] for r in hit if str(r["b"]) in parts}
            stored = self._store.read_parts(self._layer, self._fact, near, part.schema)
            delta |= {c.check_name: newly_repeated(c, added, stored).first()["n"] for c in unique}
        self._delta = delta

    def store(self) -> DataFrame | None:
        """The report of the fact's current version; None while the fact is not stored."""
        now, held = self._store.current_version(self._layer, self._fact), self._store.read(self._layer, self._name)
        of = self._store.properties(self._layer, self._name).get(OF_VERSION)
        if now is None:
            return None
        if held is None or of != now:
            if held is not None and self._delta is not None and of == self._before:
                change = F.create_map(*[F.lit(x) for pair in self._delta.items() for x in pair])
                found = held.withColumn("failures", (F.col("failures") + F.coalesce(F.try_element_at(change, F.col("check_name")), F.lit(0))).cast("bigint"))
            else:
                found = run_checks(self._checks, {self._fact: self._store.read(self._layer, self._fact)}).drop("status")
            held = self._store.write(found.coalesce(1), self._layer, self._name, properties={OF_VERSION: now})
        return with_status(held)
