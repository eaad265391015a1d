"""The declared check suite over the model graph.

Sources, staging and intermediate checks warn; mart checks and the three singular
checks fail (error severity). 86 generic + 3 singular = 89 checks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.checks import ERROR, ROW_LEVEL, UNIQUENESS, WARN, Check, failing_rows, run_checks
from strata.plans.project import Project, scratch_keeper
from strata.sources import testdata

# The accepted rating range.
RATING_MIN = 0.5
RATING_MAX = 5.0


def _nn(model: str, cols: Sequence[str], sev: str) -> list[Check]:
    return [Check("not_null", model, (c,), sev) for c in cols]


def _uq(model: str, col: str, sev: str) -> list[Check]:
    return [Check("unique", model, (col,), sev)]


def _combo(model: str, cols: Sequence[str], sev: str) -> list[Check]:
    return [Check("unique_combination_of_columns", model, tuple(cols), sev)]


def _range(model: str, col: str, sev: str) -> list[Check]:
    return [Check("accepted_range", model, (col,), sev, RATING_MIN, RATING_MAX)]


# The declared checks, by layer.
SOURCE_CHECKS = [
    *_uq("raw_movies", "movieId", WARN),
    *_nn("raw_movies", ["movieId", "title", "genres"], WARN),
    *_nn("raw_ratings", ["userId", "movieId", "rating"], WARN),
    *_nn("raw_tags", ["userId", "movieId", "tag"], WARN),
    *_uq("raw_genome_tags", "tagId", WARN),
    *_nn("raw_genome_tags", ["tagId", "tag"], WARN),
    *_nn("raw_genome_scores", ["movieId", "tagId", "relevance"], WARN),
    *_nn("raw_links", ["movieId", "imdbId", "tmdbId"], WARN),
]

STAGING_CHECKS = [
    *_uq("stg_movies", "movie_id", WARN),
    *_nn("stg_movies", ["movie_id", "title", "genres"], WARN),
    *_combo("stg_ratings", ["user_id", "movie_id"], WARN),
    *_nn("stg_ratings", ["user_id", "movie_id", "rating", "rating_timestamp"], WARN),
    *_range("stg_ratings", "rating", WARN),
    *_combo("stg_tags", ["user_id", "movie_id", "tag"], WARN),
    *_nn("stg_tags", ["user_id", "movie_id", "tag", "tag_timestamp"], WARN),
    *_uq("stg_genome_tags", "tag_id", WARN),
    *_nn("stg_genome_tags", ["tag_id", "tag"], WARN),
    *_combo("stg_genome_scores", ["movie_id", "tag_id"], WARN),
    *_nn("stg_genome_scores", ["movie_id", "tag_id", "relevance"], WARN),
    *_nn("stg_links", ["movie_id", "imdb_id", "tmdb_id"], WARN),
]

INTERMEDIATE_CHECKS = [
    *_uq("int_movies_with_links", "movie_id", WARN),
    *_nn("int_movies_with_links", ["movie_id", "title"], WARN),
    *_combo("int_genres_exploded", ["movie_id", "genre"], WARN),
    *_nn("int_genres_exploded", ["movie_id", "genre"], WARN),
    *_uq("int_ratings_summary", "movie_id", WARN),
    *_nn("int_ratings_summary", ["movie_id"], WARN),
    *_combo("int_movie_top_tags", ["movie_id", "tag_id"], WARN),
    *_nn("int_movie_top_tags", ["movie_id", "tag_id"], WARN),
]

MART_CHECKS = [
    *_uq("dim_movies", "movie_sk", ERROR),
    *_nn("dim_movies", ["movie_sk"], ERROR),
    *_uq("dim_movies", "movie_id", ERROR),
    *_nn("dim_movies", ["movie_id", "title"], ERROR),
    *_uq("dim_tags", "tag_sk", ERROR),
    *_nn("dim_tags", ["tag_sk"], ERROR),
    *_uq("dim_tags", "tag_id", ERROR),
    *_nn("dim_tags", ["tag_id", "tag"], ERROR),
    *_combo("fct_ratings", ["user_id", "movie_id"], ERROR),
    *_uq("fct_ratings", "rating_sk", ERROR),
    *_nn("fct_ratings", ["rating_sk", "user_id", "movie_id", "rating"], ERROR),
    *_range("fct_ratings", "rating", ERROR),
    *_nn("fct_ratings", ["rating_timestamp"], ERROR),
    *_combo("fct_tag_applications", ["user_id", "movie_id", "tag"], ERROR),
    *_uq("fct_tag_applications", "tag_application_sk", ERROR),
    *_nn("fct_tag_applications", ["tag_application_sk", "user_id", "movie_id", "tag", "tag_timestamp"], ERROR),
    *_combo("fct_genre_ratings", ["movie_id", "genre"], ERROR),
    *_uq("fct_genre_ratings", "genre_rating_sk", ERROR),
    *_nn("fct_genre_ratings", ["genre_rating_sk", "movie_id", "genre", "display_genre"], ERROR),
]

# Singular checks (fixed): every genre row has a display genre; every rating and every tag
# application refers to a known movie.
SINGULAR_CHECKS = [
    Check("not_null", "fct_genre_ratings", ("display_genre",), ERROR, name="all_genre_have_display_genre"),
    Check(
        "relationships", "fct_ratings", ("movie_id",), ERROR,
        parent="dim_movies", parent_column="movie_id", name="all_rating_have_movies",
    ),
    Check(
        "relationships", "fct_tag_applications", ("movie_id",), ERROR,
        parent="dim_movies", parent_column="movie_id", name="all_tag_applications_have_movies",
    ),
]

SUITE = SOURCE_CHECKS + STAGING_CHECKS + INTERMEDIATE_CHECKS + MART_CHECKS + SINGULAR_CHECKS


def suite(kinds: Sequence[str] | None = None) -> list[Check]:
    """The declared checks, optionally of some kinds only; duplicates (the same
    check declared twice) are evaluated once."""
    chosen = [c for c in SUITE if kinds is None or c.kind in kinds]
    return list(dict.fromkeys(chosen))


class LazyFrames(Mapping):
    """Model name -> DataFrame, built on first access and kept: a check run builds
    (and, for incremental facts, reads the mark of) only the models it checks."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def testdata_frames(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """Every checked relation, whole, built over the stand-in tables on first use; models made by a shuffle
    are derived once and checked as stored. ``dim_movies_day2`` is the
    dimension rebuilt from the second catalogue delivery (which withdraws some
    movies)."""
    src = testdata.sources(spark, sf_dir, repeated_links=True)
    p = Project(spark, src, keep=scratch_keeper(spark))
    day2 = Project(spark, src.replace(raw_movies=testdata.edited_raw_movies(src.raw_movies)))
    builders: dict[str, Callable[[], DataFrame]] = {
        "raw_movies": lambda: src.raw_movies,
        "raw_ratings": lambda: src.raw_ratings,
        "raw_tags": lambda: src.raw_tags,
        "raw_genome_tags": lambda: src.raw_genome_tags,
        "raw_genome_scores": lambda: src.raw_genome_scores,
        "raw_links": lambda: src.raw_links,
        "dim_movies_day2": lambda: day2.dim_movies,
    }
    for name in Project.MODEL_NAMES:
        builders.setdefault(name, (lambda n: lambda: p.model(n))(name))
    return LazyFrames(builders)


def kept_checks(fact: str) -> list[Check]:
    """The declared checks of an incremental fact that its loads can keep up to date (all but those against other models)."""
    return [c for c in suite() if c.model == fact and c.kind in ROW_LEVEL + UNIQUENESS]


def report(frames: Mapping[str, DataFrame], kinds: Sequence[str] | None = None) -> DataFrame:
    return run_checks(suite(kinds), frames)


def lookup_complete_failures(fct_genre_ratings: DataFrame) -> DataFrame:
    """Genre rows without a display genre (all columns of the failing rows)."""
    return fct_genre_ratings.where(F.col("display_genre").isNull())


def orphan_failures(fact: DataFrame, dim_movies: DataFrame) -> DataFrame:
    """movie_id of every fact row whose movie is not in the dimension (a NULL
    movie_id counts as an orphan)."""
    check = Check("relationships", "fact", ("movie_id",), parent="dim", parent_column="movie_id")
    return failing_rows(check, {"fact": fact, "dim": dim_movies}).select("movie_id")
