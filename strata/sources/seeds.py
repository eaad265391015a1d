"""Seed lookups: small, checked-in tables loaded next to the models."""

from __future__ import annotations

import csv
import io
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.schemas import GENRE_MAPPING

# Genre lookup for the stand-in catalogue built over the test tables (part types,
# adjectives and nouns of part names). Every value but "ring" is mapped, so the
# unmapped path is exercised; "large" and "LARGE" share one display value.
TESTDATA_GENRE_MAPPING_ROWS = [
    ("ECONOMY", "Economy"),
    ("LARGE", "Large"),
    ("MEDIUM", "Medium"),
    ("PROMO", "Promo"),
    ("SMALL", "Small Type"),
    ("STANDARD", "Standard"),
    ("blue", "Blue"),
    ("cold", "Cold"),
    ("hot", "Hot"),
    ("large", "Large"),
    ("new", "New"),
    ("old", "Old"),
    ("red", "Red"),
    ("small", "Small"),
    ("anvil", "Anvil"),
    ("bolt", "Bolt"),
    ("gear", "Gear"),
    ("gizmo", "Gizmo"),
    ("plate", "Plate"),
    ("rod", "Rod"),
    ("widget", "Widget"),
    ("(no genres listed)", "Unknown"),
]

# A seed is loaded on the driver and shipped inside the plan; only a small one is marked for broadcast.
MAX_SEED_BROADCAST_BYTES = 8 * 1024 * 1024


def seed_size_bytes(rows: list[tuple]) -> int:
    """Upper bound of the seed's in-memory size (value text plus per-value overhead)."""
    return sum(len(str(v)) + 16 for r in rows for v in r)


def seed_frame(spark: SparkSession, rows: list[tuple], schema: StructType = GENRE_MAPPING) -> DataFrame:
    """The seed as a DataFrame, marked for broadcast.

    A frame built from local rows carries no size statistics, so the planner would
    never broadcast it on its own; here the size is known exactly on the driver and
    the hint is only set below ``MAX_SEED_BROADCAST_BYTES``.
    """
    df = spark.createDataFrame(rows, schema)
    if seed_size_bytes(rows) <= MAX_SEED_BROADCAST_BYTES:
        df = F.broadcast(df)
    return df


def parse_seed_csv(text: str, schema: StructType = GENRE_MAPPING) -> list[tuple]:
    """Rows of a header CSV as strings; quoted values with commas, quotes, brackets
    and apostrophes survive unchanged."""
    reader = csv.reader(io.StringIO(text))
    header = next(reader)
    names = [f.name for f in schema.fields]
    if [h.strip() for h in header] != names:
        raise ValueError(f"seed header {header} does not match {names}")
    return [tuple(r) for r in reader if r]


def read_seed_csv(spark: SparkSession, path: str, schema: StructType = GENRE_MAPPING) -> DataFrame:
    """Load a seed CSV that sits on a shared file system (readable by executors)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def packaged_seed_rows(name: str = "genre_mapping") -> list[tuple]:
    """Rows of a seed CSV that ships with the package."""
    return parse_seed_csv(files("strata").joinpath("data", f"{name}.csv").read_text(encoding="utf-8"))


def genre_mapping(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, packaged_seed_rows())


def testdata_genre_mapping(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, TESTDATA_GENRE_MAPPING_ROWS)
