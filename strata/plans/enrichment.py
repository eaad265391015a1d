"""Catalogue enrichment: key selection, payload intake, keyed upsert, load report.

The HTTP calls themselves are outside the engine: responses arrive as a table of
(request order, status, body) and are filtered, parsed and upserted on Spark as
one set-based batch instead of one MERGE per film.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.scd2 import as_of_column
from strata.plans.attempts import due_keys
from strata.operators.upsert import upsert
from strata.sources.schemas import TMDB_MOVIES
from strata.sources.storage import empty_frame

# HTTP statuses that count as fetched / not found.
OK_STATUS = 200
NOT_FOUND_STATUS = 404

# Payload field -> (target column, type). A missing field gives NULL.
PAYLOAD_FIELDS = (
    ("id", "tmdb_id", "bigint"),
    ("title", "title", "string"),
    ("overview", "overview", "string"),
    ("runtime", "runtime", "bigint"),
    ("popularity", "popularity", "double"),
    ("budget", "budget", "bigint"),
    ("revenue", "revenue", "bigint"),
    ("release_date", "release_date", "string"),
    ("poster_path", "poster_path", "string"),
)
UPDATE_COLUMNS = tuple(col for _, col, _ in PAYLOAD_FIELDS[1:]) + ("raw_json",)


def open_ids(dim_movies: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL external ids, without those that ``stored`` (the enrichment table) has."""
    ids = dim_movies.where(F.col("tmdb_id").isNotNull()).select("tmdb_id").distinct()
    if stored is not None:
        ids = ids.join(stored.select("tmdb_id").distinct(), "tmdb_id", "left_anti")
    return ids


def enrichment_keys(
    dim_movies: DataFrame, batch_size: int = 100, stored: DataFrame | None = None, attempts: DataFrame | None = None
) -> DataFrame:
    """Distinct non-NULL external ids to fetch next, without those that ``stored`` (the
    enrichment table) has, so that every run goes on where the last one ended. ``batch_size`` is the
    request budget of a run. Smallest first; with ``attempts`` (the ledger of all tries) those never tried first, then those tried
    longest ago, so ids that keep failing cannot hold up the others. The distinct runs as a partial+final
    aggregate; order+limit as a per-task top-n merged into one small result."""
    ids = open_ids(dim_movies, stored)
    if attempts is not None:
        return due_keys(ids, attempts, batch_size).select("tmdb_id")
    return ids.orderBy("tmdb_id").limit(batch_size)


def intake(responses: DataFrame, order_col: str | None = None, on_invalid: str = "raise") -> DataFrame:
    """The responses with their bodies parsed, once, into a VARIANT: ``(order column, asked, status, doc, body)``. Bodies of failed
    responses are never parsed; ``asked`` is the id asked for, or the body's where the capture does not name it. Written as Parquet
    (see :func:`strata.plans.build.enrich`), the column keeps its binary form, and later readers take fields from it."""
    if on_invalid not in ("raise", "skip"):
        raise ValueError("on_invalid must be 'raise' or 'skip'")
    parse = F.parse_json if on_invalid == "raise" else F.try_parse_json
    ok = F.col("status") == OK_STATUS
    doc = F.when(ok, parse(F.col("body")))
    get = F.variant_get if on_invalid == "raise" else F.try_variant_get
    parsed = responses.select(
        *([order_col] if order_col else []), "status", doc.alias("doc"), F.when(ok, F.col("body")).alias("body"),
        (F.col("tmdb_id") if "tmdb_id" in responses.columns else F.lit(None)).cast("bigint").alias("asked"),
    )
    return parsed.withColumn("asked", F.coalesce("asked", get("doc", "$.id", "bigint")))


def typed(taken: DataFrame, order_col: str | None = None, on_invalid: str = "raise") -> DataFrame:
    """The successful responses of an :func:`intake` as typed rows."""
    get = F.variant_get if on_invalid == "raise" else F.try_variant_get
    fields = [get(F.col("doc"), f"$.{name}", typ).alias(col) for name, col, typ in PAYLOAD_FIELDS]
    ok = taken.where((F.col("status") == OK_STATUS) & F.col("doc").isNotNull())
    rows = ok.select(*([order_col] if order_col else []), *fields, F.col("body").alias("raw_json"))
    return rows.where(F.col("tmdb_id").isNotNull())


def parse_payloads(responses: DataFrame, order_col: str | None = None, on_invalid: str = "raise") -> DataFrame:
    """Successful responses as typed rows; ``raw_json`` keeps the body text.

    Non-200 responses are skipped. Each body is parsed once into a VARIANT and the
    fields are read from it with ``variant_get`` (a missing field is NULL, a value that is
    not of the column's type raises), instead of re-parsing the text per field. An invalid body raises,
    as PARSE_JSON does (``on_invalid="raise"``); ``on_invalid="skip"`` drops such
    rows, and reads mistyped fields as NULL, so one bad body cannot fail a large batch.
    Rows without an id are rejected (a NULL key matches nothing and would be inserted again by every
    run); ``load_report`` counts them.
    """
    return typed(intake(responses, order_col, on_invalid), order_col, on_invalid)


def empty_target(spark: SparkSession) -> DataFrame:
    """The enrichment table when none is stored yet (create-if-missing)."""
    return empty_frame(spark, TMDB_MOVIES)


def payload_upsert(
    target: DataFrame, responses: DataFrame, as_of: dt.datetime | None = None, order_col: str = "event_id"
) -> DataFrame:
    """Upsert one batch of responses by tmdb_id. A film fetched twice in a batch
    keeps its last response (by ``order_col``), as the one-MERGE-per-film loop
    does; ``loaded_at`` is the load time on insert and on update: ``as_of`` when
    given (repeatable runs), else the query's current timestamp."""
    return upsert_parsed(target, parse_payloads(responses, order_col), as_of, order_col)


def upsert_parsed(target: DataFrame, parsed: DataFrame, as_of: dt.datetime | None = None, order_col: str = "event_id") -> DataFrame:
    """:func:`payload_upsert` of responses that are parsed already."""
    loaded = as_of_column(as_of) if as_of is not None else F.current_timestamp()
    return upsert(
        target,
        parsed,
        ["tmdb_id"],
        update_cols=UPDATE_COLUMNS + ("loaded_at",),
        on_duplicate="latest",
        order_cols=[order_col],
        insert_values={"loaded_at": loaded},
        update_values={"loaded_at": loaded},
    )


def load_report(target: DataFrame, responses: DataFrame) -> DataFrame:
    """:func:`report_of` of responses that are not parsed yet."""
    return report_of(target, intake(responses))


def report_of(target: DataFrame, taken: DataFrame) -> DataFrame:
    """One row describing an :func:`intake`: requests, outcomes by status, films loaded
    (successful responses with an id), responses rejected for want of one, and distinct films inserted vs updated.

    One left join of the batch to the target's distinct keys, then one aggregate.
    Bodies of failed responses are never parsed.
    """
    status = F.col("status")
    ok = status == OK_STATUS
    batch = taken.select(status.alias("status"), F.when(ok, F.variant_get("doc", "$.id", "bigint")).alias("__id"))
    known = target.select(F.col("tmdb_id").alias("__k")).where(F.col("__k").isNotNull()).distinct()
    known = known.withColumn("__known", F.lit(True))
    joined = batch.join(known, F.col("__id") == F.col("__k"), "left")
    is_known = F.col("__known").isNotNull()
    return joined.agg(
        F.count(F.lit(1)).cast("bigint").alias("keys_queried"),
        F.count_if(ok).cast("bigint").alias("movies_fetched"),
        F.count_if(status == NOT_FOUND_STATUS).cast("bigint").alias("not_found"),
        F.count_if(~status.isin(OK_STATUS, NOT_FOUND_STATUS)).cast("bigint").alias("other_errors"),
        F.count_if(ok & F.col("__id").isNotNull()).cast("bigint").alias("movies_loaded"),
        F.count_if(ok & F.col("__id").isNull()).cast("bigint").alias("without_id"),
        F.count_distinct(F.when(~is_known, F.col("__id"))).cast("bigint").alias("keys_inserted"),
        F.count_distinct(F.when(is_known, F.col("__id"))).cast("bigint").alias("keys_updated"),
    )
