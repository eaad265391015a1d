"""Staging views: 1:1 renames of the raw tables (no filter, no de-duplication).

``carry`` keeps extra raw columns (e.g. an arrival-order column) through staging for
operators that need them; by default nothing beyond the model's columns is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_movies(raw_movies: DataFrame) -> DataFrame:
    return raw_movies.select(
        F.col("movieId").alias("movie_id"),
        F.col("title"),
        F.col("genres"),
    )


def stg_ratings(raw_ratings: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return raw_ratings.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.col("rating"),
        F.timestamp_seconds(F.col("timestamp")).alias("rating_timestamp"),
        *carry,
    )


def stg_tags(raw_tags: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return raw_tags.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.col("tag"),
        F.timestamp_seconds(F.col("timestamp")).alias("tag_timestamp"),
        *carry,
    )


def stg_genome_tags(raw_genome_tags: DataFrame) -> DataFrame:
    return raw_genome_tags.select(F.col("tagId").alias("tag_id"), F.col("tag"))


def stg_genome_scores(raw_genome_scores: DataFrame) -> DataFrame:
    return raw_genome_scores.select(
        F.col("movieId").alias("movie_id"),
        F.col("tagId").alias("tag_id"),
        F.col("relevance"),
    )


def stg_links(raw_links: DataFrame) -> DataFrame:
    return raw_links.select(
        F.col("movieId").alias("movie_id"),
        F.col("imdbId").alias("imdb_id"),
        F.col("tmdbId").alias("tmdb_id"),
    )
