"""Intermediate models: joins, explode, summaries and top-k tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import explode_delimited, extract_year
from strata.operators.joins import lookup_join, skew_safe_left_join
from strata.operators.topk import top_k_per_group

# Fixed value: tags kept per movie.
TOP_TAGS_PER_MOVIE = 10


def int_movies_with_links(stg_movies: DataFrame, stg_links: DataFrame) -> DataFrame:
    """Movie ⟕ links on movie_id. Unmatched movies keep NULL link columns; duplicate
    link rows fan out. Both sides grow with the catalogue, so the join strategy is
    left to the planner (AQE broadcasts a side that is small at runtime); the join
    is written skew-safe, so a movie with a third of all link rows is split."""
    joined = skew_safe_left_join(stg_movies, stg_links.select("movie_id", "imdb_id", "tmdb_id"), "movie_id")
    return joined.select(
        "movie_id",
        "title",
        extract_year(F.col("title")).alias("release_year"),
        "genres",
        "imdb_id",
        "tmdb_id",
    )


def int_genres_exploded(int_movies_with_links: DataFrame) -> DataFrame:
    """One row per (movie, trimmed genre piece); a NULL genres string gives no row."""
    return explode_delimited(int_movies_with_links, "genres", "|", "genre", keep=["movie_id"])


def int_ratings_summary(stg_ratings: DataFrame) -> DataFrame:
    """Per-movie rating statistics. Partial aggregation runs before the shuffle, so a
    movie holding a third of all ratings still moves one row per task."""
    return stg_ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count("rating").alias("rating_count"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


def int_movie_top_tags(stg_genome_scores: DataFrame, stg_genome_tags: DataFrame, k: int = TOP_TAGS_PER_MOVIE) -> DataFrame:
    """The k most relevant tags per movie, ranked before the name lookup.

    Ranking runs first, so a tag id without a name leaves a gap in ``tag_rank``.
    Relevance sorts descending with NULLs first; ties break on tag_id.
    """
    ranked = top_k_per_group(
        stg_genome_scores,
        ["movie_id"],
        [F.col("relevance").desc_nulls_first(), F.col("tag_id").asc_nulls_last()],
        k,
        "tag_rank",
    )
    return lookup_join(ranked, stg_genome_tags, "tag_id", how="inner").select(
        "movie_id", "tag_id", "tag", "relevance", "tag_rank"
    )


def int_ratings(stg_ratings: DataFrame) -> DataFrame:
    return stg_ratings.select("user_id", "movie_id", "rating", "rating_timestamp")


def int_tag_applications(stg_tags: DataFrame) -> DataFrame:
    return stg_tags.select("user_id", "movie_id", "tag", "tag_timestamp")


def int_tags(stg_genome_tags: DataFrame) -> DataFrame:
    return stg_genome_tags.select("tag_id", "tag")
