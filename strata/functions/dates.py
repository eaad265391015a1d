"""Date spine and time-grain truncation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def _as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date, column: str = "date_day") -> DataFrame:
    """One row per day in ``[start, end)``: the end day is excluded.

    Built from ``spark.range`` so the days are generated in parallel by the
    executors instead of as one array in one task.
    """
    s, e = _as_date(start), _as_date(end)
    n = max((e - s).days, 0)
    return spark.range(0, n, 1).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias(column))


def date_spine_between(df: DataFrame, ts_col: str, column: str = "date_day") -> DataFrame:
    """Spine covering every day from the first to the last day seen in ``ts_col``.

    The bounds come from one global min/max aggregate (partial per task, then one
    row), the days from ``date_spine``; both ends are included.
    """
    row = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi")).first()
    spark = df.sparkSession
    if row is None or row["lo"] is None:
        return date_spine(spark, "1970-01-01", "1970-01-01", column)
    return date_spine(spark, row["lo"], row["hi"] + dt.timedelta(days=1), column)


def trunc_to_grain(ts: str | Column, grain: str) -> Column:
    """Start date of the ``grain`` period holding ``ts`` (weeks start on Monday)."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")
    c = F.col(ts) if isinstance(ts, str) else ts
    if grain == "day":
        return F.to_date(c)
    return F.to_date(F.date_trunc(grain, c))
