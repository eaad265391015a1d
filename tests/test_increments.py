"""State that each run updates from what changed: histories, rating histograms, orphans, merged metrics, SQL functions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.sql import register_functions
from strata.operators.checks import Check, run_checks
from strata.operators.metrics import Measure, Metric, SemanticModel, metric_query
from strata.operators.scd2 import scd2_apply
from strata.operators.upsert import upsert
from strata.plans import check_state, orphans, rating_histogram, snapshots
from strata.plans.check_state import KeptChecks
from strata.plans.loads import effects, load_incremental_fact
from strata.plans.rating_histogram import KeptHistogram
from strata.sources.storage import TableStore

DAY = [dt.datetime(2024, 3, 1 + d, 6) for d in range(5)]


def rows(df):
    return sorted(map(repr, df.collect()))


def films(spark, **changed):
    return spark.createDataFrame([(k, changed.get(f"k{k}", "a")) for k in range(20) if changed.get(f"k{k}") != "gone"], "k bigint, v string")


def test_a_stored_history_leaves_closed_files_alone(spark, tmp_path):
    path = tmp_path / "history"
    history, plain = snapshots.History(spark, str(path)), None
    assert history.read() is None
    deliveries = [films(spark), films(spark, k3="b", k4="b"), films(spark, k3="c", k4="b", k5="gone"), films(spark, k3="c", k4="d")]
    files = []
    for day, source in zip(DAY, deliveries, strict=False):
        out = history.take(source, "k", ["v"], day)
        plain = scd2_apply(plain, source, "k", ["v"], day)
        assert rows(out) == rows(plain) and out.columns == plain.columns
        files.append({str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet")})
    closed = {f: t for f, t in files[-2].items() if "closed_on=current" not in f}
    assert len({f.split("/")[0] for f in closed}) == 2 and closed.items() <= files[-1].items()
    assert not any("closed_on=current" in f for f in files[-2].keys() & files[-1].keys())


def test_snapshots_on_one_day_and_the_same_snapshot_again(spark, tmp_path):
    history = snapshots.History(spark, str(tmp_path / "history"))
    history.take(films(spark), "k", ["v"], DAY[0])
    first = history.take(films(spark, k1="b"), "k", ["v"], DAY[1])
    again = rows(first)
    assert rows(history.take(films(spark, k1="b"), "k", ["v"], DAY[1])) == again
    later = DAY[1] + dt.timedelta(hours=5)  # the day's partition holds the morning's closed versions too
    out = history.take(films(spark, k1="b", k2="c"), "k", ["v"], later)
    assert sorted((r.k, r.valid_to) for r in out.where("valid_to IS NOT NULL").collect()) == [(1, DAY[1]), (2, later)]
    assert out.count() == 22


def test_a_history_goes_on_from_an_earlier_one_and_refuses_a_broken_write(spark, tmp_path):
    earlier = scd2_apply(None, films(spark), "k", ["v"], DAY[0])
    history = snapshots.History(spark, str(tmp_path / "history"), earlier)
    assert rows(history.read()) == rows(earlier)
    assert rows(history.take(films(spark, k1="b"), "k", ["v"], DAY[1])) == rows(scd2_apply(earlier, films(spark, k1="b"), "k", ["v"], DAY[1]))
    (tmp_path / "history" / ".spark-staging-1").mkdir()
    with pytest.raises(snapshots.HistoryError):
        history.read()


RATINGS = "user_id bigint, movie_id bigint, rating double, rating_timestamp timestamp, event_id bigint"
KEYS, ORDER = ["user_id", "movie_id"], ["rating_timestamp", "event_id"]


def ratings(spark, seed, n, day):
    rng = random.Random(seed)
    pick = lambda k: rng.choice([*range(k), None])
    out = [(pick(6), pick(5), rng.choice([0.5, 1.0, 4.5, 5.0, None]), day + dt.timedelta(seconds=rng.randint(0, 99)), i) for i in range(n)]
    return spark.createDataFrame(out, RATINGS)


def test_changes_are_the_difference_of_the_histograms(spark):
    for seed in range(4):
        part, batch = ratings(spark, seed, 60, DAY[0]).drop("event_id"), ratings(spark, seed + 50, 25, DAY[1])
        after = upsert(part, batch, KEYS, on_duplicate="latest", order_cols=ORDER)
        delta = rating_histogram.changes(part, batch, KEYS, "latest", ORDER)
        got = rating_histogram._added_up(rating_histogram.histogram(part).unionByName(delta))
        assert rows(got) == rows(rating_histogram.histogram(after))
        full = after.groupBy("movie_id").agg(
            F.avg("rating").alias("avg_rating"), F.count("rating").alias("rating_count"),
            F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
        )
        assert rows(rating_histogram.summary(got)) == rows(full)
        replaced, added = effects(part, batch, KEYS, "latest", ORDER)
        assert part.count() + added.count() == after.count() and replaced.select(*KEYS).distinct().count() <= 30


def test_a_histogram_follows_the_loads_and_is_rebuilt_after_a_lost_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), keep_versions=1)

    def load(seed, day, follow=True):
        kept = KeptHistogram(store, "marts", "f", KEYS, "latest", ORDER)
        raw = ratings(spark, seed, 40, day).withColumn("timestamp", F.unix_seconds("rating_timestamp"))
        fact = load_incremental_fact(
            store, "marts", "f", raw, lambda r: r.drop("timestamp"), KEYS, "rating_timestamp", "latest", "event_id", buckets=4, changed=kept.changed
        )
        if follow:
            assert rows(kept.store()) == rows(rating_histogram.histogram(fact))
        return kept

    load(1, DAY[0])
    assert load(2, DAY[1])._delta is not None
    load(3, DAY[2], follow=False)  # the run dies before it stores the histogram
    load(4, DAY[3])
    version = store.current_version("marts", rating_histogram.NAME)
    load(4, DAY[3])  # nothing new: nothing is written
    assert store.current_version("marts", rating_histogram.NAME) == version


def test_kept_checks_equal_the_full_suite_without_reading_the_fact(spark, tmp_path, monkeypatch):
    checks = [
        Check("not_null", "f", ("user_id",)), Check("not_null", "f", ("rating",), "warn"), Check("accepted_range", "f", ("rating",), "error", 1.0, 4.5),
        Check("unique_combination_of_columns", "f", ("user_id", "movie_id")), Check("unique", "f", ("sk",), "warn"),
    ]
    store = TableStore(spark, str(tmp_path), keep_versions=1)
    sk = F.md5(F.concat_ws("-", F.coalesce(F.col("user_id").cast("string"), F.lit("null")), F.coalesce(F.col("movie_id").cast("string"), F.lit("null"))))

    def load(seed, day, n=40):
        kept = KeptChecks(store, "marts", "f", checks, KEYS, ["sk"], "latest", ORDER)
        raw = ratings(spark, seed, n, day).withColumn("timestamp", F.unix_seconds("rating_timestamp")).withColumn("sk", sk)
        load_incremental_fact(
            store, "marts", "f", raw, lambda r: r.drop("timestamp"), KEYS, "rating_timestamp", "latest", "event_id", buckets=8, changed=kept.changed
        )
        return kept.store()

    full = lambda: rows(run_checks(checks, {"f": store.read("marts", "f")}))
    first = load(1, DAY[0])
    assert rows(first) == full() and any(r.failures for r in first.collect())
    with monkeypatch.context() as m:
        m.setattr(check_state, "run_checks", None)  # from here on the fact is not checked whole
        reports = [rows(load(seed, DAY[seed - 1], n)) for seed, n in ((2, 5), (3, 60), (3, 60))]
    assert reports[-1] == full() == reports[-2] and reports[0] != reports[1]
    with pytest.raises(ValueError):
        KeptChecks(store, "marts", "f", [Check("unique", "f", ("rating",))], KEYS, ["sk"], "latest", ORDER)


def test_kept_orphans_equal_the_full_check(spark):
    keys = lambda xs: spark.createDataFrame([(x,) for x in xs], "movie_id bigint")
    before, dim1, dim2 = keys([1, 1, 2, 3, 9, 9, None]), keys([1, 2, 3, 3, None]), keys([2, 2, 3, 9, 10])
    added = keys([1, 7, 7, 9, 10, None, 2])
    held = orphans.orphans(before, dim1)
    assert rows(held) == rows(spark.createDataFrame([(9, 2), (None, 1)], "movie_id bigint, n bigint"))
    after = orphans.orphans_after(held, added, before, dim1, dim2)
    assert rows(after) == rows(orphans.orphans(before.unionByName(added), dim2))


def model(frame):
    m = {a: Measure(a, a, "id" if a == "count_distinct" else "x", "ts") for a in ("average", "count", "count_distinct", "sum", "min", "max")}
    return SemanticModel("m", frame, "e", "id", ("x",), {"ts": "day"}, m, {a: Metric(a, a) for a in m})


def test_merged_days_equal_one_aggregate_per_grain(spark):
    rng = random.Random(4)
    ids = [0, 1, 2, 32766, 32767, 32768, 32769, 65536, 2**31 - 1, None]
    data = [(rng.choice(ids), rng.choice([None, 0.5, 2.0, 3.5]), DAY[0] + dt.timedelta(days=rng.randint(0, 75))) for _ in range(800)]
    data += [(None, None, DAY[0] + dt.timedelta(days=200)), (5, 1.0, None)]
    frame = spark.createDataFrame(data, "id bigint, x double, ts timestamp")
    names = ["average", "count", "count_distinct", "sum", "min", "max"]
    grains = ("day", "week", "month")
    got = metric_query(model(frame), names, grains=grains)
    text = metric_query(model(frame.withColumn("id", F.col("id").cast("string"))), names, grains=grains)  # rows emitted per grain
    assert rows(got) == rows(text) and got.columns == text.columns
    plain = metric_query(model(frame), names[:2], grains=("month",))
    assert rows(plain) == rows(frame.groupBy(F.lit("month").alias("grain"), F.to_date(F.date_trunc("month", "ts")).alias("metric_time")).agg(
        F.avg("x").alias("average"), F.count("x").alias("count")))
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    first = plan.index("Generate explode" if "Generate explode" in plan else "Generate (")
    assert "bitmap_construct_agg" in plan and "Expand" not in plan and first >= 0


@pytest.mark.parametrize("bad", [-1, 2**31])
def test_ids_that_no_bitmap_takes_raise(spark, bad):
    frame = spark.createDataFrame([(bad, 1.0, DAY[0])], "id bigint, x double, ts timestamp")
    with pytest.raises(Exception, match="outside 0"):
        metric_query(model(frame), ["count_distinct"], grains=("day",)).collect()


def test_sql_functions(spark):
    register_functions(spark)
    one = spark.sql(
        "SELECT surrogate_key(array('1', NULL)) AS k, extract_year('Heat (1995) (2001)') AS y, extract_year('Heat') AS none, "
        "trunc_to_grain(TIMESTAMP '2024-02-08 10:00:00', 'week') AS w"
    ).first()
    assert one.k == spark.sql("SELECT md5('1-_dbt_utils_surrogate_key_null_') AS k").first().k
    assert (one.y, one.none, one.w) == ("1995", None, dt.date(2024, 2, 5))
    got = spark.sql("SELECT i, piece FROM VALUES (1, 'a| b||'), (2, ''), (3, NULL) AS t(i, s), LATERAL explode_delimited(s, '|')")
    assert sorted(map(tuple, got.collect())) == [(1, ""), (1, ""), (1, "a"), (1, "b"), (2, "")]
    days = spark.sql("SELECT * FROM date_spine(DATE '2024-02-28', DATE '2024-03-02')").collect()
    assert [r.date_day for r in days] == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert spark.sql("SELECT * FROM date_spine(DATE '2024-03-02', DATE '2024-03-02')").collect() == []
