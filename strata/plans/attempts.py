"""The ledger of enrichment attempts: which id was asked for, when, and with what status.

Ids answered 404 or 500 are never stored as films, so "not stored yet" alone would put the same failed ids at the head of every
batch. The ledger is an append-only Parquet folder, a row per attempt; nothing in it is ever rewritten. An id is due by its latest
attempt: ids never tried first, then those tried longest ago, so failed ids come round again after all others.

A run that dies between storing films and appending its attempts loses the attempts only: its failed ids are tried again. A run
that is repeated appends them twice, which changes no latest attempt.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.scd2 import as_of_column
from strata.session import path_exists
from strata.sources.schemas import ATTEMPTS
from strata.sources.storage import empty_frame


class AttemptLedger:
    """The attempts stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return empty_frame(self.spark, ATTEMPTS)
        return self.spark.read.schema(ATTEMPTS).parquet(self.path)

    def record(self, asked: DataFrame, as_of: dt.datetime) -> None:
        """Append the attempts of one batch, ``(tmdb_id, status)``; rows without an id are no attempt on any."""
        rows = asked.where(F.col("tmdb_id").isNotNull()).select("tmdb_id", "status", as_of_column(as_of).alias("attempted_at"))
        rows.write.mode("append").parquet(self.path)


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """``(tmdb_id, last_status, last_attempt)``, one row per id ever tried. The latest is a maximum, combined in each task before the
    shuffle, so an id with very many attempts moves one row per task."""
    latest = F.max(F.struct("attempted_at", "status")).alias("latest")
    per_id = attempts.where(F.col("tmdb_id").isNotNull()).groupBy("tmdb_id").agg(latest)
    return per_id.select("tmdb_id", F.col("latest.status").alias("last_status"), F.col("latest.attempted_at").alias("last_attempt"))


def due_keys(ids: DataFrame, attempts: DataFrame, batch_size: int) -> DataFrame:
    """The ``batch_size`` ids that are due, ``(tmdb_id, last_status, last_attempt)``: never tried first, then the oldest
    attempt first. One join on the id, unique on both sides, then a top-n per task."""
    tried = latest_attempts(attempts).withColumnRenamed("tmdb_id", "__tried")
    due = ids.join(tried, F.col("tmdb_id") == F.col("__tried"), "left").drop("__tried")
    return due.orderBy(F.asc_nulls_first("last_attempt"), "tmdb_id").limit(batch_size)
