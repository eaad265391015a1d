"""Marts: dimensions and facts with hashed surrogate keys, and the time spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import date_spine, surrogate_key
from strata.operators.joins import lookup_join

# Bounds of the generated daily time spine (end day excluded).
SPINE_START = "1995-01-09"
SPINE_END = "2015-03-31"


def dim_movies(int_movies_with_links: DataFrame) -> DataFrame:
    return int_movies_with_links.select(
        surrogate_key("movie_id").alias("movie_sk"),
        "movie_id",
        "title",
        "release_year",
        "genres",
        "imdb_id",
        "tmdb_id",
    )


def dim_tags(int_tags: DataFrame) -> DataFrame:
    return int_tags.select(surrogate_key("tag_id").alias("tag_sk"), "tag_id", "tag")


def fct_ratings_rows(int_ratings: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Body of the ratings fact; the incremental wrapper adds the mark and upsert."""
    return int_ratings.select(
        surrogate_key("user_id", "movie_id").alias("rating_sk"),
        "user_id",
        "movie_id",
        "rating",
        "rating_timestamp",
        *carry,
    )


def fct_tag_applications_rows(int_tag_applications: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return int_tag_applications.select(
        surrogate_key("user_id", "movie_id", "tag").alias("tag_application_sk"),
        "user_id",
        "movie_id",
        "tag",
        "tag_timestamp",
        *carry,
    )


def fct_genre_ratings(
    int_genres_exploded: DataFrame, genre_mapping: DataFrame, int_ratings_summary: DataFrame
) -> DataFrame:
    """(movie, genre) rows with the display genre and the movie's rating summary.

    The lookup seed is broadcast (size checked); the summary is one row per movie
    and meets the genre rows in an equi-join on movie_id. A movie's numbers repeat
    on each of its genres; an unrated movie keeps NULL average and NULL count.
    """
    mapping = genre_mapping.select(F.col("raw_genre").alias("genre"), "display_genre")
    with_display = lookup_join(int_genres_exploded, mapping, "genre", how="left")
    summary = int_ratings_summary.select("movie_id", "avg_rating", "rating_count")
    joined = with_display.join(summary, "movie_id", "left")
    return joined.select(
        surrogate_key("movie_id", "genre").alias("genre_rating_sk"),
        "movie_id",
        "genre",
        "display_genre",
        "avg_rating",
        "rating_count",
    )


def metricflow_time_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    return date_spine(spark, start, end, "date_day")
