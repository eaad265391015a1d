import pytest

from strata.operators.checks import ERROR, WARN, Check, CheckFailed, enforce, failing_rows, run_checks


@pytest.fixture
def frames(spark):
    fact = spark.createDataFrame(
        [(1, 10, 0.5), (1, 10, 5.0), (2, None, 6.0), (3, 11, None), (4, 99, 1.0)],
        "user_id bigint, movie_id bigint, rating double",
    )
    dim = spark.createDataFrame([(10,), (11,), (11,)], "movie_id bigint")
    return {"fact": fact, "dim": dim}


def _by_name(report):
    return {r.check_name: (r.failures, r.status) for r in report.collect()}


def test_each_check_kind(spark, frames):
    checks = [
        Check("not_null", "fact", ("movie_id",), WARN),
        Check("not_null", "fact", ("rating",), ERROR),
        Check("accepted_range", "fact", ("rating",), WARN, 0.5, 5.0),
        Check("unique", "dim", ("movie_id",), WARN),
        Check("unique", "fact", ("movie_id",), WARN),
        Check("unique_combination_of_columns", "fact", ("user_id", "movie_id"), ERROR),
        Check("relationships", "fact", ("movie_id",), ERROR, parent="dim", parent_column="movie_id", name="orph"),
    ]
    got = _by_name(run_checks(checks, frames))
    assert got["not_null__fact__movie_id"] == (1, "warn")
    assert got["not_null__fact__rating"] == (1, "fail")
    assert got["accepted_range__fact__rating"] == (1, "warn")  # 6.0 fails, NULL passes
    assert got["unique__dim__movie_id"] == (1, "warn")
    assert got["unique__fact__movie_id"] == (1, "warn")  # NULL ignored, 10 twice
    assert got["unique_combination_of_columns__fact__user_id__movie_id"] == (1, "fail")
    assert got["orph"] == (2, "fail")  # NULL movie and movie 99


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a bigint, b bigint")
    ch = Check("unique_combination_of_columns", "t", ("a", "b"), WARN)
    assert failing_rows(ch, {"t": df}).count() == 1


def test_enforce_raises_only_on_error(spark, frames):
    warn_only = run_checks([Check("not_null", "fact", ("movie_id",), WARN)], frames)
    assert enforce(warn_only)[0]["status"] == "warn"
    with pytest.raises(CheckFailed):
        enforce(run_checks([Check("not_null", "fact", ("movie_id",), ERROR)], frames))


def test_declared_suite_size():
    from strata.plans import quality

    s = quality.suite()
    assert len(s) == 89
    assert sum(c.severity == WARN for c in s) == 55
    assert sum(c.kind == "not_null" for c in s) == 64  # 63 generic + 1 singular
