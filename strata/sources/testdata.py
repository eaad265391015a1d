"""Stand-in raw tables over the driver's test tables.

The catalogue, ratings, tags, genome and links inputs are not in the test data, so
each raw input is a view over one of the given tables. Every view is a narrow
projection of one scan: no shuffle, and filters/column pruning reach Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.raw import RawSources
from strata.sources.seeds import testdata_genre_mapping

# Fixed parameters of the stand-ins.
HISTORY_CUTOFF = "2024-01-20 00:00:00"  # ratings at or before it form the stored history
LATE_EVERY = 10  # every tenth event (by id) is held back from the history: late data
YEAR_BASE = 1950  # title year = YEAR_BASE + part size


_TABLES: dict[tuple, DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table, read once per session (the test tables are read-only, so a
    cached file listing cannot go stale)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _epoch_seconds(ts: str):
    # events.ts is a timestamp without zone; with the session zone pinned to UTC
    # the cast keeps wall-clock = UTC and unix_seconds floors to whole seconds.
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    year = F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" ("), (F.lit(YEAR_BASE) + F.col("p_size")).cast("string"), F.lit(")"))
    )
    genres = F.when(F.col("p_partkey") % 50 == 0, F.lit("(no genres listed)")).otherwise(
        F.concat(F.col("p_type"), F.lit("| "), F.replace(F.col("p_name"), F.lit(" "), F.lit("|")))
    )
    return p.select(
        F.col("p_partkey").cast("bigint").alias("movieId"),
        F.concat(F.col("p_name"), year).alias("title"),
        genres.alias("genres"),
    )


def raw_links(spark: SparkSession, sf_dir: str, repeated: bool = False) -> DataFrame:
    """Links; with ``repeated``, every 97th movie has a second one, so the join to the catalogue fans out."""
    c = _table(spark, sf_dir, "customer").withColumn("again", F.lit(0))
    if repeated:
        both = F.when(F.col("c_custkey") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        c = c.withColumn("again", F.explode(both))
    return c.select(
        F.col("c_custkey").cast("bigint").alias("movieId"),
        F.concat(F.col("c_name"), F.when(F.col("again") == 1, F.lit("-b")).otherwise(F.lit(""))).alias("imdbId"),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("c_custkey") + F.lit(100000))
        .cast("bigint")
        .alias("tmdbId"),
    )


def _events_after(spark: SparkSession, sf_dir: str, after, until: str | None = None) -> DataFrame:
    """The events, optionally only those whose whole-second time is after ``after`` (epoch
    microseconds) and at or before ``until`` (wall-clock text, UTC).

    floor(ts) > after  <=>  ts >= after + 1 s for a whole-second ``after``, and
    floor(ts) <= until  <=>  ts < until + 1 s: plain comparisons on the stored
    column, so they reach the Parquet scan as pushed filters and row groups outside
    the range are skipped by their statistics.
    """
    e = _table(spark, sf_dir, "events")
    one_second = F.expr("INTERVAL 1 SECOND")
    if after is not None:
        bound = F.timestamp_micros(F.lit(after)) + one_second
        e = e.where(F.col("ts") >= bound.cast("timestamp_ntz"))
    if until is not None:
        bound = F.to_timestamp(F.lit(until)) + one_second
        e = e.where(F.col("ts") < bound.cast("timestamp_ntz"))
    return e


def raw_ratings(spark: SparkSession, sf_dir: str, after=None, until: str | None = None) -> DataFrame:
    """Ratings with ``event_id`` kept as the arrival-order column; with ``after`` /
    ``until``, only ratings stamped (in whole seconds) after / at or before them."""
    e = _events_after(spark, sf_dir, after, until)
    rating = F.least(F.lit(5.0), F.lit(0.5) * F.ceil(F.col("value") / F.lit(10.0)).cast("double"))
    return e.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("movieId"),
        rating.cast("double").alias("rating"),
        _epoch_seconds("ts").alias("timestamp"),
    )


def raw_tags(spark: SparkSession, sf_dir: str, after=None, until: str | None = None) -> DataFrame:
    e = _events_after(spark, sf_dir, after, until)
    return e.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("movieId"),
        F.col("event_type").alias("tag"),
        _epoch_seconds("ts").alias("timestamp"),
    )


def raw_genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("tagId"), F.col("n_name").alias("tag"))


def raw_genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (vector, position), some without a relevance: a narrow generator, no shuffle."""
    emb = _table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.posexplode("embedding")).select(
        F.col("vec_id").cast("bigint").alias("movieId"),
        F.col("pos").cast("bigint").alias("tagId"),
        F.when((F.col("vec_id") + F.col("pos")) % 41 != 0, F.col("col").cast("double")).alias("relevance"),
    )


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured API responses: (event_id, status, body)."""
    e = _table(spark, sf_dir, "events")
    status = (
        F.when(F.col("event_type") == "error", F.lit(404))
        .when(F.col("event_type") == "signup", F.lit(500))
        .otherwise(F.lit(200))
        .cast("bigint")
    )
    eid = F.col("event_id")

    def number(c):
        return c.cast("bigint").cast("string")

    def every(n, c, other="null"):
        return F.when(eid % n == 0, F.lit(other)).otherwise(c)

    # All nine fields, with JSON nulls and missing fields among them; every 40th has no id.
    fields = [
        F.concat(F.lit('"id": '), every(40, F.get_json_object(F.col("props"), "$.k"))),
        F.concat(F.lit('"title": "'), F.col("event_type"), F.lit('"')),
        F.concat(F.lit('"overview": '), every(3, F.concat(F.lit('"o '), number(eid), F.lit('"')))),
        every(5, F.concat(F.lit('"runtime": '), number(eid % 240)), '"tagline": "none"'),
        F.concat(F.lit('"popularity": '), F.col("value").cast("string")),
        F.concat(F.lit('"budget": '), number(eid * 1000)),
        F.concat(F.lit('"revenue": '), every(7, number(eid * 1999))),
        F.concat(F.lit('"release_date": "'), F.date_format(F.col("ts"), "yyyy-MM-dd"), F.lit('"')),
        F.concat(F.lit('"poster_path": '), every(11, F.concat(F.lit('"/p'), number(eid), F.lit('.jpg"')))),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    return e.select(F.col("event_id").cast("bigint").alias("event_id"), status.alias("status"), body.alias("body"))


def raw_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts to fetch an id, two per id: (tmdb_id, status, attempted_at). Every twentieth id was not asked for yet."""
    e = _table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", 404).when(F.col("event_type") == "signup", 500).otherwise(200)
    number = F.expr("event_id div 2")
    return e.select(
        F.when(number % 20 != 3, number + 100000).cast("bigint").alias("tmdb_id"),
        status.cast("bigint").alias("status"),
        F.col("ts").cast("timestamp").alias("attempted_at"),
    )


def edited_raw_movies(raw: DataFrame) -> DataFrame:
    """Second delivery of the catalogue for the history tests: genres extended for
    ids divisible by 7, titles edited for ids divisible by 5, ids divisible by 11
    withdrawn, and ids divisible by 13 re-issued under id + 1,000,000."""
    mid = F.col("movieId")
    edited = raw.select(
        mid,
        F.concat(F.col("title"), F.when(mid % 5 == 0, F.lit("!")).otherwise(F.lit(""))).alias("title"),
        F.concat(F.col("genres"), F.when(mid % 7 == 0, F.lit("|Extra")).otherwise(F.lit(""))).alias("genres"),
    )
    kept = edited.where(mid % 11 != 0)
    reissued = edited.where(mid % 13 == 0).select((mid + F.lit(1_000_000)).alias("movieId"), "title", "genres")
    return kept.unionByName(reissued)


def sources(spark: SparkSession, sf_dir: str, repeated_links: bool = False) -> RawSources:
    return RawSources(
        raw_movies=lambda: raw_movies(spark, sf_dir),
        raw_ratings=lambda: raw_ratings(spark, sf_dir),
        raw_tags=lambda: raw_tags(spark, sf_dir),
        raw_genome_tags=lambda: raw_genome_tags(spark, sf_dir),
        raw_genome_scores=lambda: raw_genome_scores(spark, sf_dir),
        raw_links=lambda: raw_links(spark, sf_dir, repeated_links),
        genre_mapping=lambda: _seed(spark),
    )


def _seed(spark: SparkSession) -> DataFrame:
    """The stand-in genre seed, built once per session."""
    key = (id(spark), spark.sparkContext.applicationId, "seed:genre_mapping")
    if key not in _TABLES:
        _TABLES[key] = testdata_genre_mapping(spark)
    return _TABLES[key]
