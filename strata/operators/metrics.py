"""Semantic models and simple metrics.

A semantic model names a fact frame, its primary entity, its dimensions and its
measures; a simple metric exposes one measure. ``metric_query`` answers any set of
metrics by any categorical dimensions and time grains from a single scan.

Time grains without other dimensions are merged: one aggregate per day holds sums, counts, extremes and, for an exact distinct count of
integer ids, a bitmap per 32,768 ids; weeks and months are made from the days (bitmaps by OR), so no fact row is
emitted more than once and ids are never shuffled. A bitmap takes 4 KB however few ids it holds, so groupings with dimensions, where a
day has few rows, and other types emit each row once per grain (the expansion Spark uses for grouping
sets) before the partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import GRAINS, trunc_to_grain

AGGREGATIONS = {
    "average": lambda c: F.avg(c),
    "count": lambda c: F.count(c),
    "count_distinct": lambda c: F.count_distinct(c),  # exact, never approximate
    "sum": lambda c: F.sum(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


#: Largest id that a bitmap takes: 65,536 bitmaps a day at most.
LARGEST_ID = 2**31 - 1
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_ADDED = (*_WHOLE, "float", "double")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str
    agg_time_dimension: str | None = None

    def column(self) -> Column:
        if self.agg not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation {self.agg!r}")
        return AGGREGATIONS[self.agg](F.col(self.expr))


@dataclass(frozen=True)
class Metric:
    """A simple metric: one measure, exposed under its own name."""

    name: str
    measure: str


@dataclass
class SemanticModel:
    name: str
    frame: DataFrame
    primary_entity: str
    entity_expr: str
    categorical_dimensions: tuple[str, ...] = ()
    time_dimensions: dict[str, str] = field(default_factory=dict)  # name -> finest grain
    measures: dict[str, Measure] = field(default_factory=dict)
    metrics: dict[str, Metric] = field(default_factory=dict)


def _mergeable(measures: Sequence[tuple[str, Measure]], types: dict[str, str]) -> bool:
    """Whether days can be merged: at most one column of distinct ids, integers, and sums that do not depend on their type's scale."""
    ids = {m.expr for _, m in measures if m.agg == "count_distinct"}
    added = {m.expr for _, m in measures if m.agg in ("average", "sum")}
    return len(ids) <= 1 and all(types[c] in _WHOLE for c in ids) and all(types[c] in _ADDED for c in added)


def _by_merged_days(frame: DataFrame, measures: Sequence[tuple[str, Measure]], grains: Sequence[str], time_dimension: str) -> DataFrame:
    day, ids = [], next((m.expr for _, m in measures if m.agg == "count_distinct"), None)
    merge, final = [], []  # of days into a period's bitmaps' groups, and of those into the period
    for i, (name, m) in enumerate(measures):
        c, n = F.col(m.expr), f"__{i}"
        if m.agg == "count_distinct":
            final.append(F.coalesce(F.sum(F.bitmap_count("__bits")), F.lit(0)).cast("bigint").alias(name))
            continue
        if m.agg in ("average", "sum"):
            day.append(F.sum(c).alias(n))
            merge.append(F.sum(n).alias(n))
        if m.agg in ("min", "max"):
            day.append(AGGREGATIONS[m.agg](c).alias(n))
            merge.append(AGGREGATIONS[m.agg](F.col(n)).alias(n))
        if m.agg in ("average", "count"):
            day.append(F.count(c).alias(f"{n}n"))
            merge.append(F.sum(f"{n}n").alias(f"{n}n"))
        total, count = F.sum(n), F.sum(f"{n}n")
        final.append({
            "average": lambda: F.when(count > 0, total.cast("double") / count),
            "count": lambda: count, "sum": lambda: total, "min": lambda: F.min(n), "max": lambda: F.max(n),
        }[m.agg]().alias(name))
    keys, bucket = [trunc_to_grain(time_dimension, "day").alias("__day")], []
    if ids is not None:
        message = F.concat(F.lit(f"{ids} is outside 0..{LARGEST_ID}: "), F.col(ids).cast("string"))
        inside = F.col(ids).between(0, LARGEST_ID) | F.col(ids).isNull()
        known = F.when(inside, F.col(ids).cast("bigint")).otherwise(F.raise_error(message).cast("bigint"))
        keys.append(F.bitmap_bucket_number(known).alias("__bucket"))
        day.append(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(ids).cast("bigint"))).alias("__bits"))
        merge.append(F.bitmap_or_agg("__bits").alias("__bits"))
        bucket = ["__bucket"]
    days = frame.groupBy(*keys).agg(*day)
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), trunc_to_grain("__day", g).alias("metric_time")) for g in grains])
    spread = days.withColumn("__p", F.explode(periods)).withColumns({"grain": F.col("__p.grain"), "metric_time": F.col("__p.metric_time")})
    merged = spread.groupBy("grain", "metric_time", *bucket).agg(*merge)
    return merged.groupBy("grain", "metric_time").agg(*final)


def metric_query(
    model: SemanticModel,
    metric_names: Sequence[str],
    group_by: Sequence[str] = (),
    grains: Sequence[str] | None = None,
    time_dimension: str | None = None,
) -> DataFrame:
    """Metrics by the given dimensions; with ``grains``, also by time period.

    Output: the group-by dimensions, then (with grains) ``grain`` and
    ``metric_time`` (start date of the period), then one column per metric.
    No dimensions and no grains gives a single row.
    """
    unknown = [d for d in group_by if d not in model.categorical_dimensions]
    if unknown:
        raise ValueError(f"{unknown} are not dimensions of {model.name}")
    measures = []
    for name in metric_names:
        if name not in model.metrics:
            raise ValueError(f"unknown metric {name!r}")
        measures.append((name, model.measures[model.metrics[name].measure]))
    aggs = [m.column().alias(name) for name, m in measures]

    frame = model.frame
    keys = [F.col(d) for d in group_by]
    if grains:
        if time_dimension is None:
            time_dimension = measures[0][1].agg_time_dimension
        if time_dimension not in model.time_dimensions:
            raise ValueError(f"{time_dimension!r} is not a time dimension of {model.name}")
        bad = [g for g in grains if g not in GRAINS]
        if bad:
            raise ValueError(f"unknown grains {bad}")
        if not group_by and _mergeable(measures, dict(frame.dtypes)):
            return _by_merged_days(frame, measures, grains, time_dimension)
        periods = F.array(
            *[F.struct(F.lit(g).alias("grain"), trunc_to_grain(time_dimension, g).alias("metric_time")) for g in grains]
        )
        needed = list(dict.fromkeys([*group_by, *(m.expr for _, m in measures)]))
        frame = frame.select(*needed, F.explode(periods).alias("__p")).select(*needed, "__p.grain", "__p.metric_time")
        keys += [F.col("grain"), F.col("metric_time")]
    if keys:
        return frame.groupBy(*keys).agg(*aggs)
    return frame.agg(*aggs)
