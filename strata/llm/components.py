"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import own_shuffle, stored


def _neighbours(edges: DataFrame) -> DataFrame:
    """``(u, m, hangs, holds)`` per vertex: its least neighbour, how many smaller ones it has, and whether it has a larger one.

    Partial aggregates: a vertex with very many edges sends one row per task."""
    both = edges.selectExpr("a AS u", "b AS v").unionByName(edges.selectExpr("b AS u", "a AS v"))
    larger = F.col("v") > F.col("u")
    return both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(~larger).alias("hangs"), F.max(larger.cast("int")).alias("holds"))


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every vertex hangs on one other that hangs on none; one count comes to the driver."""
    return _neighbours(edges).agg(F.count_if(F.expr("hangs + holds > 1 AND hangs > 0"))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each vertex's larger neighbours to the least of it and its neighbours."""
    least = _neighbours(edges).where("holds = 1").select(own_shuffle(F.col("u")).alias("u"), F.least("u", "m").alias("m"))
    return edges.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each vertex and its smaller neighbours to the least of these."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select(own_shuffle(F.col("u")).alias("u"), "m")
    near = edges.join(least, F.col("a") == F.col("u"))
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.selectExpr("u AS a", "m AS b")).where("a <> b")


def stars(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges(a, b)`` but the components' smallest vertices, which name them.

    ``edges`` is read several times, so it should be a stored table; an edge that is given twice costs a round at most.
    Each round is written to the shared folder. Rounds grow with the logarithm of the largest component's diameter.
    """
    now = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b")
    while not _is_star_forest(now):
        now = stored(_small_star(_large_star(now)).distinct(), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges(a, b)``; the component is its smallest vertex. See ``stars``."""
    hung = stars(edges)
    return hung.unionByName(hung.select(F.col("component").alias("id"), "component").distinct())
