"""Raw source tables.

``RawSources`` bundles the six raw inputs as lazy DataFrames. ``from_parquet`` reads a
real landing zone (one folder per table) with the pinned schemas; the stand-ins over
the test tables live in ``strata.sources.testdata``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from strata.sources.schemas import RAW_SCHEMAS


class RawSources:
    """The raw inputs of one build. Each may be given as a DataFrame or as a
    zero-argument builder; builders run on first access, so a query constructs
    only the inputs it reads."""

    NAMES = (
        "raw_movies",
        "raw_ratings",
        "raw_tags",
        "raw_genome_tags",
        "raw_genome_scores",
        "raw_links",
        "genre_mapping",
    )

    def __init__(self, **frames: DataFrame | Callable[[], DataFrame]):
        missing = [n for n in self.NAMES if n not in frames]
        unknown = [n for n in frames if n not in self.NAMES]
        if missing or unknown:
            raise TypeError(f"missing inputs {missing}, unknown inputs {unknown}")
        self._given = dict(frames)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        given = self.__dict__.get("_given")
        if given is None or name not in given:
            raise AttributeError(name)
        built = self.__dict__["_built"]
        if name not in built:
            value = given[name]
            built[name] = value if isinstance(value, DataFrame) else value()
        return built[name]

    def replace(self, **frames: DataFrame | Callable[[], DataFrame]) -> "RawSources":
        values = {n: self._built.get(n, self._given[n]) for n in self.NAMES}
        values.update(frames)
        return RawSources(**values)


ORDERED_TABLES = ("raw_ratings", "raw_tags")


def read_raw_table(spark: SparkSession, path: str, name: str, order_col: str | None = None) -> DataFrame:
    """Read one raw table with its pinned schema (column pruning and filters still
    reach the Parquet scan). ``order_col`` adds a bigint arrival-order column to
    the ratings and tags tables."""
    schema = RAW_SCHEMAS[name]
    if order_col and name in ORDERED_TABLES:
        schema = StructType(schema.fields + [StructField(order_col, LongType())])
    return spark.read.schema(schema).parquet(path)


def from_parquet(
    spark: SparkSession, root: str, genre_mapping: DataFrame, order_col: str | None = None
) -> RawSources:
    frames = {
        name: read_raw_table(spark, f"{root.rstrip('/')}/{name}", name, order_col) for name in RAW_SCHEMAS
    }
    return RawSources(genre_mapping=genre_mapping, **frames)
