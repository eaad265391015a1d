"""Explicit schemas of the raw inputs and of the enrichment target table.

Downstream schemas are inferred by the DataFrame API; only the edges are pinned.
"""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RAW_MOVIES = StructType(
    [
        StructField("movieId", LongType()),
        StructField("title", StringType()),
        StructField("genres", StringType()),
    ]
)

RAW_RATINGS = StructType(
    [
        StructField("userId", LongType()),
        StructField("movieId", LongType()),
        StructField("rating", DoubleType()),
        StructField("timestamp", LongType()),
    ]
)

RAW_TAGS = StructType(
    [
        StructField("userId", LongType()),
        StructField("movieId", LongType()),
        StructField("tag", StringType()),
        StructField("timestamp", LongType()),
    ]
)

RAW_GENOME_TAGS = StructType([StructField("tagId", LongType()), StructField("tag", StringType())])

RAW_GENOME_SCORES = StructType(
    [
        StructField("movieId", LongType()),
        StructField("tagId", LongType()),
        StructField("relevance", DoubleType()),
    ]
)

RAW_LINKS = StructType(
    [
        StructField("movieId", LongType()),
        StructField("imdbId", StringType()),
        StructField("tmdbId", LongType()),
    ]
)

GENRE_MAPPING = StructType(
    [StructField("raw_genre", StringType()), StructField("display_genre", StringType())]
)

# Captured API responses: one row per requested id.
RAW_RESPONSES = StructType(
    [
        StructField("request_id", LongType()),
        StructField("status", LongType()),
        StructField("body", StringType()),
        StructField("tmdb_id", LongType()),  # the id asked for; NULL in captures that do not name it
    ]
)

# One row per attempt to fetch an id, whatever came of it.
ATTEMPTS = StructType(
    [
        StructField("tmdb_id", LongType()),
        StructField("status", LongType()),
        StructField("attempted_at", TimestampType()),
    ]
)

# Enrichment target. ``raw_json`` keeps the payload text; a VARIANT can be derived
# from it with ``parse_json`` but cannot be compared or de-duplicated.
TMDB_MOVIES = StructType(
    [
        StructField("tmdb_id", LongType()),
        StructField("title", StringType()),
        StructField("overview", StringType()),
        StructField("runtime", LongType()),
        StructField("popularity", DoubleType()),
        StructField("budget", LongType()),
        StructField("revenue", LongType()),
        StructField("release_date", StringType()),
        StructField("poster_path", StringType()),
        StructField("raw_json", StringType()),
        StructField("loaded_at", TimestampType()),
    ]
)

RAW_SCHEMAS = {
    "raw_movies": RAW_MOVIES,
    "raw_ratings": RAW_RATINGS,
    "raw_tags": RAW_TAGS,
    "raw_genome_tags": RAW_GENOME_TAGS,
    "raw_genome_scores": RAW_GENOME_SCORES,
    "raw_links": RAW_LINKS,
}
