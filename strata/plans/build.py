"""One daily build of the whole model graph into a ``TableStore``.

Order: seed -> table marts (full rebuild) -> incremental facts (high-water mark +
keyed upsert over the stored version) -> check suite over the stored results ->
snapshots (type-2 history over the stored version). An error-severity failure
stops the build before the snapshots, the models that depend on the checked marts. Staging and intermediate models
stay lazy views (optionally registered as temp views for SQL users); nothing is
collected to the driver except each incremental batch's ``max(ts)`` (the next
high-water mark, kept as version metadata) and the check report (one row per check).

Every stored model is read back after writing, so downstream steps start from
files, not from the full upstream lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.checks import enforce, run_checks
from strata.plans import enrichment, marts, quality, snapshots, staging
from strata.plans.attempts import AttemptLedger
from strata.plans.check_state import KeptChecks
from strata.plans.facts import RATING_KEYS, TAG_KEYS
from strata.plans.loads import load_incremental_fact, merge_buckets
from strata.plans.project import Project, scratch_keeper
from strata.plans.rating_histogram import NAME as HISTOGRAM
from strata.plans.rating_histogram import KeptHistogram
from strata.session import configure
from strata.sources.raw import RawSources
from strata.sources.schemas import TMDB_MOVIES
from strata.sources.storage import TableStore

MARTS = "marts"
SEEDS = "seeds"
SNAPSHOTS = "snapshots"
RAW = "raw"


@dataclass
class BuildResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    versions: dict[str, int] = field(default_factory=dict)
    report: list[dict] = field(default_factory=list)


def _store(result: BuildResult, store: TableStore, df: DataFrame, layer: str, name: str, **kw) -> DataFrame:
    stored = store.write(df, layer, name, **kw)
    result.tables[name] = stored
    result.versions[name] = store.current_version(layer, name)
    return stored


def build(
    spark: SparkSession,
    sources: RawSources,
    store: TableStore,
    as_of: dt.datetime,
    on_duplicate: str = "error",
    order_col: str | None = None,
    fail_on_error: bool = True,
    register_views: bool = False,
) -> BuildResult:
    """Run the daily build. ``order_col`` (a raw column carried through staging)
    is required with ``on_duplicate="latest"``; ``as_of`` stamps snapshots."""
    configure(spark)
    result = BuildResult()
    p = Project(spark, sources, keep=scratch_keeper(spark))
    if register_views:
        p.register_views()

    # Seed and full-rebuild marts.
    seed = _store(result, store, sources.genre_mapping, SEEDS, "genre_mapping")
    p = Project(spark, sources.replace(genre_mapping=seed), keep=scratch_keeper(spark))
    dim_movies = _store(result, store, p.dim_movies, MARTS, "dim_movies", repartition_by=["movie_id"])
    _store(result, store, p.dim_tags, MARTS, "dim_tags")
    _store(result, store, p.fct_genre_ratings, MARTS, "fct_genre_ratings", repartition_by=["movie_id"])
    _store(result, store, p.metricflow_time_spine, MARTS, "metricflow_time_spine")

    # Incremental facts.
    carry = (order_col,) if order_col else ()
    order = {"rating": ["rating_timestamp", *carry], "tag": ["tag_timestamp", *carry]}
    kept = [
        KeptChecks(store, MARTS, "fct_ratings", quality.kept_checks("fct_ratings"), RATING_KEYS, ["rating_sk"], on_duplicate, order["rating"]),
        KeptChecks(store, MARTS, "fct_tag_applications", quality.kept_checks("fct_tag_applications"), TAG_KEYS, ["tag_application_sk"],
                   on_duplicate, order["tag"]),
    ]
    counts = KeptHistogram(store, MARTS, "fct_ratings", RATING_KEYS, on_duplicate, order["rating"])
    fct_ratings = load_incremental_fact(
        store, MARTS, "fct_ratings", sources.raw_ratings,
        lambda raw: marts.fct_ratings_rows(staging.stg_ratings(raw, carry=carry), carry=carry),
        RATING_KEYS, "rating_timestamp", on_duplicate, order_col,
        changed=lambda part, batch: (counts.changed(part, batch), kept[0].changed(part, batch)),
    )
    result.tables[HISTOGRAM] = counts.store()
    fct_tags = load_incremental_fact(
        store, MARTS, "fct_tag_applications", sources.raw_tags,
        lambda raw: marts.fct_tag_applications_rows(staging.stg_tags(raw, carry=carry), carry=carry),
        TAG_KEYS, "tag_timestamp", on_duplicate, order_col, changed=kept[1].changed,
    )
    for name, df in (("fct_ratings", fct_ratings), ("fct_tag_applications", fct_tags)):
        result.tables[name] = df
        result.versions[name] = store.current_version(MARTS, name)

    # Checks over the stored results and the lazy upstream views.
    frames = {
        "raw_movies": sources.raw_movies,
        "raw_ratings": sources.raw_ratings,
        "raw_tags": sources.raw_tags,
        "raw_genome_tags": sources.raw_genome_tags,
        "raw_genome_scores": sources.raw_genome_scores,
        "raw_links": sources.raw_links,
    }
    for name in Project.MODEL_NAMES:
        frames[name] = result.tables.get(name, p.model(name))
    frames["fct_ratings"], frames["fct_tag_applications"] = fct_ratings, fct_tags
    # The facts' own checks are kept by their loads; all others read their models.
    known = {c for name in ("fct_ratings", "fct_tag_applications") for c in quality.kept_checks(name)}
    reports = [k.store() for k in kept] + [run_checks([c for c in quality.suite() if c not in known], frames)]
    result.report = [r.asDict() for report in reports if report is not None for r in report.collect()]
    if fail_on_error:
        enforce(result.report)  # an error-severity failure stops the dependants (the snapshots of the marts)

    # Snapshots: histories of which only the open versions, and those closed today, are written.
    for name, source, key, checked in (
        ("snap_dim_movies", dim_movies, snapshots.DIM_MOVIES_KEY, snapshots.DIM_MOVIES_CHECK),
        ("snap_raw_movies", sources.raw_movies, snapshots.RAW_MOVIES_KEY, snapshots.RAW_MOVIES_CHECK),
    ):
        result.tables[name] = stored_history(store, name).take(source, key, checked, as_of)

    return result


def stored_history(store: TableStore, name: str) -> snapshots.History:
    """A stored snapshot; one that an earlier release kept in versions is where it starts from."""
    earlier = store.read(SNAPSHOTS, name) if store.exists(SNAPSHOTS, name) else None
    return snapshots.History(store.spark, f"{store.location(SNAPSHOTS, name)}/history", earlier)


def enrich(
    spark: SparkSession, store: TableStore, responses: DataFrame, as_of: dt.datetime, order_col: str = "event_id"
) -> dict:
    """Upsert one batch of API responses into ``raw/raw_tmdb_movies`` and return
    the load report. A batch without a loaded film stores none. Every response is recorded as an attempt, failed ones too."""
    configure(spark)
    target = store.read_or_empty(RAW, "raw_tmdb_movies", TMDB_MOVIES)
    # Bodies are parsed once; the report, the merge and the ledger read the stored intake.
    taken = scratch_keeper(spark)(enrichment.intake(responses, order_col))
    report = enrichment.report_of(target, taken).first().asDict()
    if report["movies_loaded"] > 0:

        def merge(part: DataFrame | None, batch: DataFrame) -> DataFrame:
            part = enrichment.empty_target(spark) if part is None else part
            return enrichment.upsert_parsed(part, batch, as_of, order_col)

        merge_buckets(store, RAW, "raw_tmdb_movies", enrichment.typed(taken, order_col), ["tmdb_id"], merge)
    if report["keys_queried"] > 0:
        attempt_ledger(store).record(taken.select(F.col("asked").alias("tmdb_id"), "status"), as_of)
    return report


def attempt_ledger(store: TableStore) -> AttemptLedger:
    return AttemptLedger(store.spark, store.location(RAW, "enrichment_attempts"))


def keys_to_enrich(store: TableStore, batch_size: int = 100) -> DataFrame:
    """Next ids to fetch: from the stored movie dimension, without those already enriched; those never tried come first, then those
    whose last attempt is longest ago."""
    dim = store.read(MARTS, "dim_movies")
    if dim is None:
        raise RuntimeError("dim_movies is not built yet; run build() first")
    return enrichment.enrichment_keys(dim, batch_size, store.read(RAW, "raw_tmdb_movies"), attempt_ledger(store).read())
