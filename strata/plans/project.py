"""The model graph over a set of raw sources.

``Project`` builds each model lazily, once, from its upstream models: reading a
model is a function call, and Spark only runs when a caller acts on a result.
Models with more than one reader are plain shared DataFrames; Catalyst reuses
their exchanges inside one plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.plans import analyses, intermediate, marts, staging
from strata.session import storage_root
from strata.sources.raw import RawSources


Keep = Callable[[DataFrame], DataFrame]


def scratch_keeper(spark: SparkSession) -> Keep:
    """Writes a model to a fresh folder in the shared storage and reads it back."""

    def keep(df: DataFrame) -> DataFrame:
        path = f"{storage_root(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


class Project:
    """``keep``, if given, is applied to every model that is made by a shuffle and read by others, when it is first
    asked for: a caller that reads many models can have each derived once (see :func:`scratch_keeper`)."""

    def __init__(self, spark: SparkSession, sources: RawSources, keep: Keep = lambda df: df):
        self.spark = spark
        self.sources = sources
        self.keep = keep

    # staging
    @cached_property
    def stg_movies(self) -> DataFrame:
        return staging.stg_movies(self.sources.raw_movies)

    @cached_property
    def stg_ratings(self) -> DataFrame:
        return staging.stg_ratings(self.sources.raw_ratings)

    @cached_property
    def stg_tags(self) -> DataFrame:
        return staging.stg_tags(self.sources.raw_tags)

    @cached_property
    def stg_genome_tags(self) -> DataFrame:
        return staging.stg_genome_tags(self.sources.raw_genome_tags)

    @cached_property
    def stg_genome_scores(self) -> DataFrame:
        return staging.stg_genome_scores(self.sources.raw_genome_scores)

    @cached_property
    def stg_links(self) -> DataFrame:
        return staging.stg_links(self.sources.raw_links)

    @cached_property
    def genre_mapping(self) -> DataFrame:
        return self.sources.genre_mapping

    # intermediate
    @cached_property
    def int_movies_with_links(self) -> DataFrame:
        return self.keep(intermediate.int_movies_with_links(self.stg_movies, self.stg_links))

    @cached_property
    def int_genres_exploded(self) -> DataFrame:
        return intermediate.int_genres_exploded(self.int_movies_with_links)

    @cached_property
    def int_ratings_summary(self) -> DataFrame:
        return self.keep(intermediate.int_ratings_summary(self.stg_ratings))

    @cached_property
    def int_movie_top_tags(self) -> DataFrame:
        return self.keep(intermediate.int_movie_top_tags(self.stg_genome_scores, self.stg_genome_tags))

    @cached_property
    def int_ratings(self) -> DataFrame:
        return intermediate.int_ratings(self.stg_ratings)

    @cached_property
    def int_tag_applications(self) -> DataFrame:
        return intermediate.int_tag_applications(self.stg_tags)

    @cached_property
    def int_tags(self) -> DataFrame:
        return intermediate.int_tags(self.stg_genome_tags)

    # marts
    @cached_property
    def dim_movies(self) -> DataFrame:
        return marts.dim_movies(self.int_movies_with_links)

    @cached_property
    def dim_tags(self) -> DataFrame:
        return marts.dim_tags(self.int_tags)

    @cached_property
    def fct_ratings(self) -> DataFrame:
        """Full-refresh form of the ratings fact (what a first incremental run stores)."""
        return marts.fct_ratings_rows(self.int_ratings)

    @cached_property
    def fct_tag_applications(self) -> DataFrame:
        return marts.fct_tag_applications_rows(self.int_tag_applications)

    @cached_property
    def fct_genre_ratings(self) -> DataFrame:
        return self.keep(marts.fct_genre_ratings(self.int_genres_exploded, self.genre_mapping, self.int_ratings_summary))

    @cached_property
    def metricflow_time_spine(self) -> DataFrame:
        return marts.metricflow_time_spine(self.spark)

    # analyses
    @cached_property
    def genre_popularity(self) -> DataFrame:
        return analyses.genre_popularity(self.fct_genre_ratings)

    @cached_property
    def top_rated_movies(self) -> DataFrame:
        return analyses.top_rated_movies(self.int_ratings_summary, self.dim_movies)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self) -> None:
        """Expose every model as a session temp view, for ``spark.sql`` users."""
        for name in self.MODEL_NAMES:
            self.model(name).createOrReplaceTempView(name)

    MODEL_NAMES = (
        "stg_movies",
        "stg_ratings",
        "stg_tags",
        "stg_genome_tags",
        "stg_genome_scores",
        "stg_links",
        "int_movies_with_links",
        "int_genres_exploded",
        "int_ratings_summary",
        "int_movie_top_tags",
        "dim_movies",
        "dim_tags",
        "fct_ratings",
        "fct_tag_applications",
        "fct_genre_ratings",
    )
