"""The ratings semantic model and its three simple metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.operators.metrics import Measure, Metric, SemanticModel, metric_query

MEASURES = {
    "average_rating": Measure("average_rating", "average", "rating", "rating_timestamp"),
    "total_ratings": Measure("total_ratings", "count", "rating_sk", "rating_timestamp"),
    "total_user_ratings": Measure("total_user_ratings", "count_distinct", "user_id", "rating_timestamp"),
}

METRICS = {
    "average_movie_rating": Metric("average_movie_rating", "average_rating"),
    "total_ratings": Metric("total_ratings", "total_ratings"),
    "total_unique_users": Metric("total_unique_users", "total_user_ratings"),
}


def ratings_model(fct_ratings: DataFrame) -> SemanticModel:
    return SemanticModel(
        name="ratings",
        frame=fct_ratings,
        primary_entity="rating",
        entity_expr="rating_sk",
        categorical_dimensions=("movie_id",),
        time_dimensions={"rating_timestamp": "day"},
        measures=MEASURES,
        metrics=METRICS,
    )


def query(
    fct_ratings: DataFrame,
    metric_names: Sequence[str],
    group_by: Sequence[str] = (),
    grains: Sequence[str] | None = None,
) -> DataFrame:
    return metric_query(ratings_model(fct_ratings), metric_names, group_by=group_by, grains=grains)
