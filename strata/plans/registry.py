"""Named queries over the test tables, one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from the
stand-in raw tables (``strata.sources.testdata``). Outputs carry no zoned
timestamps (they are shown as UTC wall-clock ``timestamp_ntz``) so they compare
cleanly with other engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.functions import date_spine_between
from strata.functions.sql import register_functions
from strata.operators.joins import lookup_join
from strata.plans import enrichment, facts, marts, metrics_catalog, orphans, quality, rating_histogram, snapshots, staging
from strata.plans.attempts import due_keys
from strata.plans.check_state import KeptChecks
from strata.plans.loads import effects, load_incremental_fact
from strata.plans.project import Project, scratch_keeper
from strata.plans.rating_histogram import KeptHistogram
from strata.session import configure, storage_root
from strata.sources import testdata
from strata.sources.seeds import genre_mapping
from strata.sources.storage import TableStore

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered runs.
SNAPSHOT_DAY_1 = dt.datetime(2024, 2, 1, 0, 0, 0)
SNAPSHOT_DAY_2 = dt.datetime(2024, 2, 2, 0, 0, 0)
PAYLOAD_LOAD_1 = dt.datetime(2024, 2, 1, 6, 0, 0)
PAYLOAD_LOAD_2 = dt.datetime(2024, 2, 2, 6, 0, 0)
ENRICHMENT_BATCH = 100
DUE_BATCH = 400
WEIGHTED_AVG_DIGITS = 6


def ntz(df: DataFrame) -> DataFrame:
    """Show zoned timestamps as UTC wall-clock timestamps without zone."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def project(spark: SparkSession, sf_dir: str) -> Project:
    configure(spark)
    return Project(spark, testdata.sources(spark, sf_dir, repeated_links=True))


def _model(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(project(spark, sf_dir).model(name))

    run.__name__ = name
    return run


# -- staging and intermediate -------------------------------------------------


def q_seed_lookup(spark, sf_dir):
    p = project(spark, sf_dir)
    mapping = p.genre_mapping.select(F.col("raw_genre").alias("genre"), "display_genre")
    return lookup_join(p.int_genres_exploded, mapping, "genre", how="left").select("movie_id", "genre", "display_genre")


def q_seed_csv_lookup(spark, sf_dir):
    """The genres of the catalogue looked up in the 21-row seed that ships as a CSV."""
    p = project(spark, sf_dir)
    mapping = genre_mapping(spark).select(F.col("raw_genre").alias("genre"), "display_genre")
    return lookup_join(p.int_genres_exploded, mapping, "genre", how="left").select("movie_id", "genre", "display_genre")


def q_release_year(spark, sf_dir):
    return project(spark, sf_dir).int_movies_with_links.select("movie_id", "title", "release_year")


def q_surrogate_key(spark, sf_dir):
    return ntz(project(spark, sf_dir).fct_ratings)


def q_genre_popularity(spark, sf_dir):
    gp = project(spark, sf_dir).genre_popularity
    return gp.select(
        "display_genre",
        F.round("weighted_avg_rating", WEIGHTED_AVG_DIGITS).alias("weighted_avg_rating"),
        "total_ratings",
    )


def q_top_rated(spark, sf_dir):
    return project(spark, sf_dir).top_rated_movies


def q_date_spine(spark, sf_dir):
    """Daily spine over the days the ratings cover, with the day's rating count
    (0 on days without ratings)."""
    p = project(spark, sf_dir)
    spine = date_spine_between(p.stg_ratings, "rating_timestamp")
    per_day = p.fct_ratings.groupBy(F.to_date("rating_timestamp").alias("date_day")).agg(
        F.count("rating_sk").alias("total_ratings")
    )
    return spine.join(per_day, "date_day", "left").select(
        "date_day", F.coalesce(F.col("total_ratings"), F.lit(0)).cast("bigint").alias("total_ratings")
    )


# -- incremental loads ----------------------------------------------------------


def q_high_water_filter(spark, sf_dir):
    configure(spark)
    return ntz(facts.new_rating_rows(spark, sf_dir))


def q_incremental_ratings(spark, sf_dir):
    configure(spark)
    return ntz(facts.incremental_fct_ratings(spark, sf_dir))


def q_incremental_tags(spark, sf_dir):
    configure(spark)
    return ntz(facts.incremental_fct_tag_applications(spark, sf_dir))


def _own_folder(spark) -> str:
    return f"{storage_root(spark).rstrip('/')}/registered/{uuid.uuid4().hex}"


_ORDER = ["rating_timestamp", "event_id"]


def _two_loads(spark, sf_dir, changed=None, between=lambda store: None):
    """Two runs over a store: run 1 writes the history as version 1, run 2 reads it and merges the feed into version 2."""
    configure(spark)
    store = TableStore(spark, _own_folder(spark))
    history = facts.stored_history(facts.rating_rows(spark, sf_dir, until=testdata.HISTORY_CUTOFF), "rating_timestamp")

    def load(raw, to_rows, changed=None):
        return load_incremental_fact(
            store, "marts", "fct_ratings", raw, to_rows, facts.RATING_KEYS, "rating_timestamp", "latest", "event_id", buckets=32,
            changed=changed,
        )

    load(history, lambda rows: rows.withColumn("event_id", F.lit(None).cast("bigint")))
    between(store)
    carry = ("event_id",)
    raw = testdata.raw_ratings(spark, sf_dir)
    return store, load(raw, lambda r: marts.fct_ratings_rows(staging.stg_ratings(r, carry=carry), carry=carry), changed)


def q_stored_incremental_ratings(spark, sf_dir):
    return ntz(_two_loads(spark, sf_dir)[1])


def q_ratings_summary_kept(spark, sf_dir):
    """The rating summary of the stored fact after two loads, from the histogram that both kept."""
    kept = []

    def between(store):
        KeptHistogram(store, "marts", "fct_ratings", facts.RATING_KEYS, "latest", _ORDER).store()
        kept.append(KeptHistogram(store, "marts", "fct_ratings", facts.RATING_KEYS, "latest", _ORDER))

    _two_loads(spark, sf_dir, lambda part, batch: kept[0].changed(part, batch), between)
    return rating_histogram.summary(kept[0].store())


def q_fact_checks_kept(spark, sf_dir):
    """The report on the stored fact after two loads, kept by both."""
    kept = []

    def between(store):
        for _ in range(2):  # after the first load, and before the second
            kept.append(KeptChecks(
                store, "marts", "fct_ratings", quality.kept_checks("fct_ratings"), facts.RATING_KEYS, ["rating_sk"], "latest", _ORDER
            ))
            kept[0].store()

    _two_loads(spark, sf_dir, lambda part, batch: kept[1].changed(part, batch), between)
    return kept[1].store()


def q_stored_rebuild(spark, sf_dir):
    """The movie dimension written, rebuilt from the second catalogue delivery, and read back from its layer's folder."""
    configure(spark)
    src = testdata.sources(spark, sf_dir, repeated_links=True)
    store = TableStore(spark, _own_folder(spark))
    for s in (src, src.replace(raw_movies=testdata.edited_raw_movies(src.raw_movies))):
        store.write(Project(spark, s).dim_movies, "marts", "dim_movies", repartition_by=["movie_id"])
    return spark.read.parquet(f"{store.location('marts', 'dim_movies')}/v{store.current_version('marts', 'dim_movies')}")


def q_stored_seed_lookup(spark, sf_dir):
    """The genres of the catalogue looked up in the stored seed."""
    p = project(spark, sf_dir)
    seed = TableStore(spark, _own_folder(spark)).write(p.genre_mapping, "seeds", "genre_mapping")
    mapping = seed.select(F.col("raw_genre").alias("genre"), "display_genre")
    return lookup_join(p.int_genres_exploded, mapping, "genre", how="left").select("movie_id", "genre", "display_genre")


def q_orphans_kept(spark, sf_dir):
    """Orphans of the stored fact after new ratings came and the second catalogue delivery withdrew movies, from those before and the
    changes."""
    src = testdata.sources(spark, sf_dir)
    day1 = project(spark, sf_dir).dim_movies.select("movie_id")
    day2 = Project(spark, src.replace(raw_movies=testdata.edited_raw_movies(src.raw_movies))).dim_movies.select("movie_id")
    keep, added, held = scratch_keeper(spark), [], []

    def changed(part, batch):
        added.append(keep(effects(part, batch, facts.RATING_KEYS, "latest", _ORDER)[1].select("movie_id")))

    def between(store):
        before = store.read("marts", "fct_ratings")
        held.extend([keep(orphans.orphans(before, day1)), before])

    _two_loads(spark, sf_dir, changed, between)
    return orphans.orphans_after(held[0], added[0], held[1], day1, day2)


# -- enrichment ------------------------------------------------------------------


def q_enrichment_keys(spark, sf_dir):
    return enrichment.enrichment_keys(project(spark, sf_dir).dim_movies, ENRICHMENT_BATCH)


def q_enrichment_keys_next(spark, sf_dir):
    """The second run: the ids of the first are stored by then."""
    dim = project(spark, sf_dir).dim_movies
    return enrichment.enrichment_keys(dim, ENRICHMENT_BATCH, enrichment.enrichment_keys(dim, ENRICHMENT_BATCH))


def q_enrichment_keys_due(spark, sf_dir):
    """What is due after two attempts on most ids: ids never tried, then the failed ones by the age of their last attempt."""
    attempts = testdata.raw_attempts(spark, sf_dir)
    enriched = attempts.where(F.col("status") == enrichment.OK_STATUS)
    return ntz(due_keys(enrichment.open_ids(project(spark, sf_dir).dim_movies, enriched), attempts, DUE_BATCH))


def _responses(spark, sf_dir):
    configure(spark)
    return testdata.raw_responses(spark, sf_dir)


def q_payload_parse(spark, sf_dir):
    return enrichment.parse_payloads(_responses(spark, sf_dir), order_col="event_id")


def _payload_target(spark, sf_dir):
    """The enrichment table as the first load stored it, and all responses."""
    resp = _responses(spark, sf_dir)
    first = resp.where(F.col("event_id") % 2 == 0)
    empty = enrichment.empty_target(spark)
    target = enrichment.payload_upsert(empty, first, PAYLOAD_LOAD_1, order_col="event_id")
    return scratch_keeper(spark)(target), resp


def q_payload_upsert(spark, sf_dir):
    target, resp = _payload_target(spark, sf_dir)
    batch = enrichment.parse_payloads(resp.where(F.col("event_id") % 2 == 1), "event_id")
    batch = scratch_keeper(spark)(batch)  # an upsert reads its batch several times; bodies are parsed once
    return ntz(enrichment.upsert_parsed(target, batch, PAYLOAD_LOAD_2, order_col="event_id"))


def q_upsert_report(spark, sf_dir):
    target, resp = _payload_target(spark, sf_dir)
    batch = resp.where(F.col("event_id") % 2 == 1)
    return enrichment.load_report(target, batch)


# -- history ---------------------------------------------------------------------


def q_scd2_dim(spark, sf_dir):
    configure(spark)
    s = testdata.sources(spark, sf_dir)
    return ntz(snapshots.snap_dim_movies_two_runs(spark, s, SNAPSHOT_DAY_1, SNAPSHOT_DAY_2))


def q_scd2_stored(spark, sf_dir):
    """The catalogue's history through a stored one, of which the second snapshot replaces two partitions."""
    configure(spark)
    s = testdata.sources(spark, sf_dir)
    return ntz(snapshots.stored_raw_movies_two_runs(spark, _own_folder(spark), s, SNAPSHOT_DAY_1, SNAPSHOT_DAY_2))


def q_sql_functions(spark, sf_dir):
    """The library's SQL functions over the model views."""
    project(spark, sf_dir).stg_movies.createOrReplaceTempView("stg_movies")
    register_functions(spark)
    return spark.sql(
        "SELECT surrogate_key(array(CAST(movie_id AS STRING), piece)) AS genre_sk, movie_id, extract_year(title) AS release_year, "
        "piece AS genre FROM stg_movies, LATERAL explode_delimited(genres, '|')"
    )


def q_scd2_raw(spark, sf_dir):
    configure(spark)
    s = testdata.sources(spark, sf_dir)
    return ntz(snapshots.snap_raw_movies_two_runs(s, SNAPSHOT_DAY_1, SNAPSHOT_DAY_2))


# -- metrics ---------------------------------------------------------------------


def _metric(names, group_by=(), grains=None):
    def run(spark, sf_dir):
        p = project(spark, sf_dir)
        return metrics_catalog.query(p.fct_ratings, names, group_by=group_by, grains=grains)

    return run


# -- checks ----------------------------------------------------------------------


def _check(kind: str | None):
    def run(spark, sf_dir):
        configure(spark)
        frames = quality.testdata_frames(spark, sf_dir)
        return quality.report(frames, kinds=None if kind is None else (kind,))

    return run


def q_check_lookup_complete(spark, sf_dir):
    return quality.lookup_complete_failures(project(spark, sf_dir).fct_genre_ratings)


def q_check_orphans(spark, sf_dir):
    configure(spark)
    frames = quality.testdata_frames(spark, sf_dir)
    return quality.orphan_failures(frames["fct_ratings"], frames["dim_movies_day2"])


def q_check_orphans_tags(spark, sf_dir):
    configure(spark)
    frames = quality.testdata_frames(spark, sf_dir)
    return quality.orphan_failures(frames["fct_tag_applications"], frames["dim_movies_day2"])


QUERIES: dict[str, QueryFn] = {
    "stg_movies": _model("stg_movies"),
    "stg_links": _model("stg_links"),
    "stg_ratings": _model("stg_ratings"),
    "stg_tags": _model("stg_tags"),
    "stg_genome_tags": _model("stg_genome_tags"),
    "stg_genome_scores": _model("stg_genome_scores"),
    "seed_lookup": q_seed_lookup,
    "seed_csv_lookup": q_seed_csv_lookup,
    "movies_with_links": _model("int_movies_with_links"),
    "release_year": q_release_year,
    "genres_exploded": _model("int_genres_exploded"),
    "ratings_summary": _model("int_ratings_summary"),
    "top_tags": _model("int_movie_top_tags"),
    "dim_movies": _model("dim_movies"),
    "dim_tags": _model("dim_tags"),
    "surrogate_key": q_surrogate_key,
    "genre_ratings": _model("fct_genre_ratings"),
    "genre_popularity": q_genre_popularity,
    "top_rated": q_top_rated,
    "date_spine": q_date_spine,
    "high_water_filter": q_high_water_filter,
    "incremental_ratings": q_incremental_ratings,
    "incremental_tags": q_incremental_tags,
    "stored_incremental_ratings": q_stored_incremental_ratings,
    "ratings_summary_kept": q_ratings_summary_kept,
    "orphans_kept": q_orphans_kept,
    "fact_checks_kept": q_fact_checks_kept,
    "stored_rebuild": q_stored_rebuild,
    "stored_seed_lookup": q_stored_seed_lookup,
    "sql_functions": q_sql_functions,
    "enrichment_keys": q_enrichment_keys,
    "enrichment_keys_next": q_enrichment_keys_next,
    "enrichment_keys_due": q_enrichment_keys_due,
    "payload_parse": q_payload_parse,
    "payload_upsert": q_payload_upsert,
    "upsert_report": q_upsert_report,
    "scd2_dim": q_scd2_dim,
    "scd2_raw": q_scd2_raw,
    "scd2_stored": q_scd2_stored,
    "metric_average": _metric(["average_movie_rating"]),
    "metric_count": _metric(["total_ratings"]),
    "metric_count_distinct": _metric(["total_unique_users"]),
    "metric_by_movie": _metric(["average_movie_rating", "total_ratings", "total_unique_users"], group_by=("movie_id",)),
    "metric_by_grain": _metric(
        ["average_movie_rating", "total_ratings", "total_unique_users"], grains=("day", "week", "month")
    ),
    "check_not_null": _check("not_null"),
    "check_unique": _check("unique"),
    "check_unique_combo": _check("unique_combination_of_columns"),
    "check_range": _check("accepted_range"),
    "check_lookup_complete": q_check_lookup_complete,
    "check_orphans": q_check_orphans,
    "check_orphans_tags": q_check_orphans_tags,
    "check_report": _check(None),
}
