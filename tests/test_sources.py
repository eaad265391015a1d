import os
import tempfile

from strata.plans.project import Project
from strata.session import configure_for_scale, shuffle_partitions_for
from strata.sources import testdata
from strata.sources.raw import from_parquet
from strata.sources import seeds
from tests.conftest import SF001


def test_landing_zone_reader_gives_same_models(spark):
    """Raw tables written as a landing zone and read back with the pinned schemas
    build the same marts as the stand-in views."""
    root = tempfile.mkdtemp(prefix="strata-raw-")
    src = testdata.sources(spark, SF001)
    for name in ("raw_movies", "raw_ratings", "raw_tags", "raw_genome_tags", "raw_genome_scores", "raw_links"):
        df = getattr(src, name)
        df.select(*[c for c in df.columns if c != "event_id"]).write.parquet(os.path.join(root, name))
    landed = from_parquet(spark, root, seeds.testdata_genre_mapping(spark))
    a = Project(spark, src).fct_genre_ratings
    b = Project(spark, landed).fct_genre_ratings
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert landed.raw_ratings.schema["timestamp"].dataType.simpleString() == "bigint"


def test_scale_settings(spark):
    assert shuffle_partitions_for(100 * 1024**4) == 409600
    assert shuffle_partitions_for(10) == 200
    keys = [
        "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.files.maxPartitionBytes",
    ]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        configure_for_scale(spark, 10 * 1024**3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
