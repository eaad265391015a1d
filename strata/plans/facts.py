"""Incremental facts over the stand-in event tables.

The stored history is the part of the events at or before the cutoff, minus every
tenth event (held back: it arrives late). The daily run then loads the whole
staging feed through the high-water mark and the keyed upsert; a key fed twice
keeps its latest row (by timestamp, then event id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.upsert import high_water_filter, high_water_mark, incremental_load
from strata.plans import marts, staging
from strata.plans.project import scratch_keeper
from strata.sources import testdata

RATING_KEYS = ["user_id", "movie_id"]
TAG_KEYS = ["user_id", "movie_id", "tag"]


def rating_rows(spark: SparkSession, sf_dir: str, after=None, until: str | None = None) -> DataFrame:
    """Ratings fact rows with the arrival-order column ``event_id`` carried along;
    with ``after`` / ``until``, only rows stamped in that range (filters pushed to
    the raw scan)."""
    raw = testdata.raw_ratings(spark, sf_dir, after, until)
    return marts.fct_ratings_rows(staging.stg_ratings(raw, carry=("event_id",)), carry=("event_id",))


def tag_rows(spark: SparkSession, sf_dir: str, after=None, until: str | None = None) -> DataFrame:
    raw = testdata.raw_tags(spark, sf_dir, after, until)
    return marts.fct_tag_applications_rows(staging.stg_tags(raw, carry=("event_id",)), carry=("event_id",))


def stored_history(rows: DataFrame, ts_col: str) -> DataFrame:
    cutoff = F.to_timestamp(F.lit(testdata.HISTORY_CUTOFF))
    hist = rows.where((F.col(ts_col) <= cutoff) & (F.col("event_id") % testdata.LATE_EVERY != 0))
    return hist.drop("event_id")


def new_rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = stored_history(rating_rows(spark, sf_dir, until=testdata.HISTORY_CUTOFF), "rating_timestamp")
    mark = high_water_mark(history, "rating_timestamp")
    rows = rating_rows(spark, sf_dir, after=mark)
    return high_water_filter(rows, "rating_timestamp", mark).drop("event_id")


def incremental_fct_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = scratch_keeper(spark)  # the fact is stored state, and the batch is read several times
    history = keep(stored_history(rating_rows(spark, sf_dir, until=testdata.HISTORY_CUTOFF), "rating_timestamp"))
    mark = high_water_mark(history, "rating_timestamp")
    return incremental_load(
        history,
        keep(high_water_filter(rating_rows(spark, sf_dir, after=mark), "rating_timestamp", mark)),
        RATING_KEYS,
        "rating_timestamp",
        on_duplicate="latest",
        order_cols=["rating_timestamp", "event_id"],
        mark=mark,
    )


def incremental_fct_tag_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = scratch_keeper(spark)  # the fact is stored state, and the batch is read several times
    history = keep(stored_history(tag_rows(spark, sf_dir, until=testdata.HISTORY_CUTOFF), "tag_timestamp"))
    mark = high_water_mark(history, "tag_timestamp")
    return incremental_load(
        history,
        keep(high_water_filter(tag_rows(spark, sf_dir, after=mark), "tag_timestamp", mark)),
        TAG_KEYS,
        "tag_timestamp",
        on_duplicate="latest",
        order_cols=["tag_timestamp", "event_id"],
        mark=mark,
    )
