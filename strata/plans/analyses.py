"""Ad-hoc analyses over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A movie needs at least 100 ratings to be ranked; the report keeps 10.
MIN_RATINGS = 100
TOP_N = 10


def genre_popularity(fct_genre_ratings: DataFrame) -> DataFrame:
    """Rating-count-weighted mean rating per display genre (the unmapped, NULL
    display genre is a group of its own), best first with NULL averages first."""
    return (
        fct_genre_ratings.groupBy("display_genre")
        .agg(
            (F.sum(F.col("avg_rating") * F.col("rating_count")) / F.sum("rating_count")).alias("weighted_avg_rating"),
            F.sum("rating_count").alias("total_ratings"),
        )
        .orderBy(F.col("weighted_avg_rating").desc_nulls_first(), F.col("display_genre").asc_nulls_first())
    )


def top_rated_movies(
    int_ratings_summary: DataFrame, dim_movies: DataFrame, min_ratings: int = MIN_RATINGS, n: int = TOP_N
) -> DataFrame:
    """The n best-rated movies among those with at least ``min_ratings`` ratings.

    The threshold filters the per-movie summary before the join, and order+limit
    plans as a per-task top-n followed by one n-row merge (no global sort).
    Ties on the average break on movie_id.
    """
    eligible = int_ratings_summary.where(F.col("rating_count") >= min_ratings)
    return (
        eligible.join(dim_movies.select("movie_id", "title"), "movie_id")
        .select("movie_id", "title", "avg_rating", "rating_count")
        .orderBy(F.col("avg_rating").desc_nulls_first(), F.col("movie_id").asc())
        .limit(n)
    )
