import datetime as dt

from strata.plans import metrics_catalog


def test_metrics_no_dims_and_grains(spark):
    fct = spark.createDataFrame(
        [
            ("a", 1, 10, 4.0, dt.datetime(2024, 1, 1, 10)),
            ("b", 1, 11, 2.0, dt.datetime(2024, 1, 2, 10)),
            ("c", 2, 10, 3.0, dt.datetime(2024, 1, 8, 10)),
            (None, 2, 10, 5.0, dt.datetime(2024, 2, 8, 10)),
        ],
        "rating_sk string, user_id bigint, movie_id bigint, rating double, rating_timestamp timestamp",
    )
    one = metrics_catalog.query(fct, ["average_movie_rating", "total_ratings", "total_unique_users"]).collect()
    assert len(one) == 1 and one[0].average_movie_rating == 3.5
    assert one[0].total_ratings == 3  # count of non-NULL keys
    assert one[0].total_unique_users == 2
    by_movie = {r.movie_id: r.total_ratings for r in metrics_catalog.query(fct, ["total_ratings"], group_by=["movie_id"]).collect()}
    assert by_movie == {10: 2, 11: 1}
    g = metrics_catalog.query(fct, ["total_ratings"], grains=["week", "month"]).collect()
    got = sorted((r.grain, r.metric_time, r.total_ratings) for r in g)
    assert got == [
        ("month", dt.date(2024, 1, 1), 3),
        ("month", dt.date(2024, 2, 1), 0),
        ("week", dt.date(2024, 1, 1), 2),
        ("week", dt.date(2024, 1, 8), 1),
        ("week", dt.date(2024, 2, 5), 0),
    ]
