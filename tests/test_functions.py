import datetime as dt

from pyspark.sql import functions as F

from strata.functions import date_spine, explode_delimited, extract_year, surrogate_key, trunc_to_grain
from strata.plans.marts import metricflow_time_spine


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k bigint, s string")
    got = [r[0] for r in df.select(surrogate_key("k", "s")).collect()]
    import hashlib

    exp = [
        hashlib.md5(b"1-a").hexdigest(),
        hashlib.md5(b"_dbt_utils_surrogate_key_null_-b").hexdigest(),
        hashlib.md5(b"2-_dbt_utils_surrogate_key_null_").hexdigest(),
    ]
    assert got == exp


def test_surrogate_key_single_column(spark):
    import hashlib

    df = spark.createDataFrame([(42,)], "movie_id bigint")
    assert df.select(surrogate_key("movie_id")).first()[0] == hashlib.md5(b"42").hexdigest()


def test_extract_year_first_match_and_null_on_miss(spark):
    df = spark.createDataFrame(
        [("Heat (1995)",), ("No year",), ("Two (1990) years (2000)",), (None,), ("Bad (19x5)",)], "title string"
    )
    got = [r[0] for r in df.select(extract_year("title")).collect()]
    assert got == ["1995", None, "1990", None, None]


def test_explode_delimited_keeps_empty_pieces_and_drops_null(spark):
    df = spark.createDataFrame(
        [(1, "A|B"), (2, ""), (3, None), (4, "A||B|"), (5, " x |\ty")], "movie_id bigint, genres string"
    )
    out = explode_delimited(df, "genres", "|", "genre", keep=["movie_id"])
    rows = sorted((r.movie_id, r.genre) for r in out.collect())
    assert rows == [
        (1, "A"), (1, "B"),
        (2, ""),
        (4, ""), (4, ""), (4, "A"), (4, "B"),
        (5, "\ty"), (5, "x"),
    ]


def test_date_spine_excludes_end(spark):
    spine = metricflow_time_spine(spark)
    row = spine.agg(F.count("*").alias("n"), F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).first()
    assert row.n == 7386
    assert row.lo == dt.date(1995, 1, 9)
    assert row.hi == dt.date(2015, 3, 30)


def test_date_spine_empty_range(spark):
    assert date_spine(spark, "2020-01-02", "2020-01-01").count() == 0


def test_week_grain_starts_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12, 0),)], "ts timestamp")  # a Sunday
    assert df.select(trunc_to_grain("ts", "week")).first()[0] == dt.date(2024, 1, 1)
    assert df.select(trunc_to_grain("ts", "month")).first()[0] == dt.date(2024, 1, 1)
    assert df.select(trunc_to_grain("ts", "day")).first()[0] == dt.date(2024, 1, 7)
