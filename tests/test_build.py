import datetime as dt
import json
import os
import subprocess
import sys
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strata.operators.checks import CheckFailed
from strata.plans import build as B
from strata.plans import loads
from strata.plans.loads import load_incremental_fact
from strata.sources import testdata
from strata.sources.storage import TableStore, UncommittedTableError
from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
D1 = dt.datetime(2024, 2, 1)
D2 = dt.datetime(2024, 2, 2)


def _sources(spark, day2=False):
    s = testdata.sources(spark, SF001)
    if day2:
        s = s.replace(raw_movies=testdata.edited_raw_movies(s.raw_movies))
    return s


def test_versioned_store_never_overwrites(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    assert store.read("marts", "t") is None
    a = store.write(spark.range(3), "marts", "t")
    assert store.current_version("marts", "t") == 1
    b = store.write(a.withColumn("id", F.col("id") + 10), "marts", "t")  # reads v1, writes v2
    assert store.versions("marts", "t") == [1, 2]
    assert sorted(r.id for r in b.collect()) == [10, 11, 12]
    assert sorted(r.id for r in store.read("marts", "t", 1).collect()) == [0, 1, 2]


def test_daily_build_twice(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    r1 = B.build(spark, _sources(spark), store, D1, on_duplicate="latest", order_col="event_id",
                 fail_on_error=False)
    n_ratings = r1.tables["fct_ratings"].count()
    assert n_ratings == spark.read.parquet(f"{SF001}/events.parquet").count()  # first run: every row
    assert r1.versions["fct_ratings"] == 1
    statuses = {r["check_name"]: r["status"] for r in r1.report}
    assert len(statuses) == 89
    assert statuses["all_genre_have_display_genre"] == "fail"  # 'ring' is unmapped in the stand-in seed
    assert statuses["unique__dim_movies__movie_id"] == "pass"

    r2 = B.build(spark, _sources(spark, day2=True), store, D2, on_duplicate="latest", order_col="event_id",
                 fail_on_error=False)
    # same events again: nothing is above the mark, the fact is unchanged
    assert r2.tables["fct_ratings"].count() == n_ratings
    assert r2.versions["fct_ratings"] == 1
    snap = r2.tables["snap_raw_movies"]
    closed = snap.where(F.col("valid_to").isNotNull()).count()
    changed = testdata.raw_movies(spark, SF001).where("movieId % 7 = 0 AND movieId % 11 != 0").count()
    assert closed == changed
    assert snap.where(F.col("valid_to").isNull()).groupBy("movieId").count().where("count > 1").count() == 0


def test_build_raises_on_error_checks(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    with pytest.raises(CheckFailed):
        B.build(spark, _sources(spark), store, D1, on_duplicate="latest", order_col="event_id")
    # the checked marts are stored; their dependants (snapshots) are not built
    assert store.exists("marts", "dim_movies") and store.exists("marts", "fct_ratings")
    assert not store.exists("snapshots", "snap_dim_movies")


def test_enrich_batches(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    resp = testdata.raw_responses(spark, SF001)
    rep1 = B.enrich(spark, store, resp.where("event_id % 2 = 0"), D1)
    assert rep1["keys_inserted"] > 0 and rep1["keys_updated"] == 0
    rep2 = B.enrich(spark, store, resp.where("event_id % 2 = 1"), D2)
    assert rep2["keys_updated"] > 0
    assert store.versions("raw", "raw_tmdb_movies") == [1, 2]
    empty = B.enrich(spark, store, resp.where("event_id < 0"), D2)
    assert empty["movies_loaded"] == 0 and store.versions("raw", "raw_tmdb_movies") == [1, 2]


def test_mark_is_kept_as_version_metadata(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    B.build(spark, _sources(spark), store, D1, on_duplicate="latest", order_col="event_id", fail_on_error=False)
    props = store.properties("marts", "fct_ratings")
    stored_max = store.read("marts", "fct_ratings").agg(F.max(F.col("rating_timestamp").cast("timestamp_ntz"))).first()[0]
    assert props["high_water_mark_micros"] == int(stored_max.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def test_layer_naming(spark):
    root = tempfile.mkdtemp(prefix="strata-store-")
    store = TableStore(spark, root, default_layer="analytics")
    assert store.location("marts", "dim_movies") == f"{root}/marts/dim_movies"
    assert store.location(None, "adhoc") == f"{root}/analytics/adhoc"


def test_store_skips_a_failed_partial_version(spark):
    root = tempfile.mkdtemp(prefix="strata-store-")
    store = TableStore(spark, root)
    store.write(spark.range(2), "marts", "t")
    os.makedirs(os.path.join(root, "marts", "t", "v2"))  # a write that died before committing
    with open(os.path.join(root, "marts", "t", "v2", "part-0.parquet"), "w") as f:
        f.write("garbage")
    assert store.current_version("marts", "t") == 1  # readers ignore it
    store.write(spark.range(5), "marts", "t")  # the retry lands in v3
    assert store.versions("marts", "t") == [1, 3]
    assert store.read("marts", "t").count() == 5


def test_only_uncommitted_versions_raise(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    (tmp_path / "marts" / "t" / "v1").mkdir(parents=True)
    with pytest.raises(UncommittedTableError):
        store.read("marts", "t")


def test_old_versions_are_retired(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), keep_versions=2)
    for n in range(1, 5):
        store.write(spark.range(n), "marts", "t")
    assert store.versions("marts", "t") == [3, 4]
    assert sorted(p.name for p in (tmp_path / "marts" / "t").iterdir()) == ["v3", "v4"]
    assert store.read("marts", "t", 3).count() == 3


def _load(spark, store, rows, **kw):
    raw = spark.createDataFrame(rows, "k bigint, v string, timestamp bigint, event_id bigint")
    return load_incremental_fact(
        store, "marts", "f", raw, lambda r: r.select("k", "v", F.timestamp_seconds("timestamp").alias("ts"), "event_id"),
        ["k"], "ts", "latest", "event_id", buckets=16, **kw,
    )


def _files(tmp_path):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "marts" / "f").rglob("part-*.parquet")}


def test_a_merge_rewrites_only_the_buckets_it_hits(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), keep_versions=1)
    _load(spark, store, [(k, "a", 100, k) for k in range(400)])
    before = _files(tmp_path)
    out = _load(spark, store, [(7, "b", 200, 1), (7, "c", 200, 2), (1000, "n", 201, 3), (None, "x", 202, 4), (5, "late", 100, 5)])
    after = _files(tmp_path)
    gone = before.keys() - after.keys()
    assert len(gone) == 1  # the one bucket that holds key 7; its old file is retired
    assert all(after[f] == before[f] for f in before.keys() - gone)
    got = {r.k: r.v for r in out.collect()}
    assert got == {k: "c" if k == 7 else "a" for k in range(400)} | {1000: "n", None: "x"}
    assert out.count() == 402
    # A batch of new keys rewrites nothing.
    before = _files(tmp_path)
    _load(spark, store, [(k, "z", 300, k) for k in range(2000, 2010)])
    after = _files(tmp_path)
    assert before.items() <= after.items() and store.read("marts", "f").count() == 412
    # And nothing above the mark changes nothing.
    assert sorted(r.k or -1 for r in _load(spark, store, [(1, "old", 10, 1)]).collect()) == sorted(
        r.k or -1 for r in store.read("marts", "f").collect()
    )
    assert store.properties("marts", "f")["high_water_mark_micros"] == 300_000_000


@pytest.mark.parametrize("dies_in", ["before", "within"])
def test_a_merge_after_a_bucketed_version_without_its_list(spark, tmp_path, monkeypatch, dies_in):
    """The driver dies when Spark has committed the rewritten buckets, before the list of all buckets is written, or within."""

    def die(*args, **kw):
        raise KeyboardInterrupt

    def load_and_die(store, version, rows):
        with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
            if dies_in == "before":
                m.setattr(TableStore, "_write_properties", die)
            else:
                m.setattr("strata.sources.storage.json", SimpleNamespace(dumps=die, loads=json.loads))
            _load(spark, store, rows)
        assert os.path.exists(f"{store.root}/marts/f/v{version}/_SUCCESS")

    first = TableStore(spark, str(tmp_path / "first"))
    load_and_die(first, 1, [(k, "lost", 50, k) for k in range(3)])
    with pytest.raises(UncommittedTableError):
        first.read("marts", "f")

    store = TableStore(spark, str(tmp_path / "second"), keep_versions=1)
    _load(spark, store, [(k, "a", 100, k) for k in range(400)])
    load_and_die(store, 2, [(7, "lost", 200, 1), (1000, "lost", 200, 2)])
    assert store.versions("marts", "f") == [1] and store.read("marts", "f").count() == 400
    for run in range(2):  # retention after the first may not take what the second needs
        out = _load(spark, store, [(7, f"b{run}", 300 + run, 1), (2000 + run, "n", 300 + run, 2)])
    want = {k: "a" for k in range(400)} | {7: "b1", 2000: "n", 2001: "n"}
    assert {r.k: r.v for r in out.collect()} == want and out.count() == len(want)
    assert out.columns == ["k", "v", "ts"] and store.versions("marts", "f") == [4]


def test_buckets_with_many_folders_are_rewritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for run in range(12):
        _load(spark, store, [(1000 * run + k, "a", run + 1, k) for k in range(64)])
    assert max(map(len, store.parts("marts", "f").values())) <= 9
    assert store.read("marts", "f").count() == 12 * 64


LOAD = """
import sys
from strata.session import local_session
from strata.sources.storage import TableStore, UncommittedTableError
from strata.plans.loads import load_incremental_fact
from pyspark.sql import functions as F
spark = local_session(2, shuffle_partitions=2)
store = TableStore(spark, sys.argv[1])
lo, hi = int(sys.argv[2]), int(sys.argv[3])
raw = spark.range(lo, hi).select(F.col("id").alias("k"), (F.lit(1700000000) + F.col("id")).alias("timestamp"))
out = load_incremental_fact(store, "marts", "f", raw, lambda r: r.select("k", F.timestamp_seconds("timestamp").alias("ts")), ["k"], "ts", buckets=4)
print("ROWS", out.count())
"""

HASH = """
import sys
from strata.session import local_session
from strata.plans.registry import QUERIES
from pyspark.sql import functions as F
spark = local_session(2, shuffle_partitions=2)
for name in ("high_water_filter", "incremental_ratings", "incremental_tags"):
    df = QUERIES[name](spark, sys.argv[1])
    print("ROWS", name, *df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())
"""


def _run(code, zone, *args):
    out = subprocess.run(
        [sys.executable, "-c", code, *map(str, args)], env=os.environ | {"TZ": zone}, cwd=ROOT, capture_output=True, text=True, check=True
    )
    return [line for line in out.stdout.splitlines() if line.startswith("ROWS")]


def test_loads_in_two_time_zones_keep_all_rows(tmp_path):
    assert _run(LOAD, "Asia/Tokyo", tmp_path, 0, 100) == ["ROWS 100"]
    assert _run(LOAD, "UTC", tmp_path, 100, 200) == ["ROWS 200"]
    assert _run(LOAD, "America/New_York", tmp_path, 0, 300) == ["ROWS 300"]


def test_marks_mean_the_same_in_every_driver_zone():
    utc, tokyo, york = (_run(HASH, zone, SF001) for zone in ("UTC", "Asia/Tokyo", "America/New_York"))
    assert utc == tokyo == york and len(utc) == 3


def test_enrichment_goes_on_where_it_ended(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(1, 31).select(F.col("id").alias("tmdb_id")), "marts", "dim_movies")
    seen = []
    for run in range(4):
        ids = [r.tmdb_id for r in B.keys_to_enrich(store, 10).collect()]
        seen += ids
        if ids:
            bodies = [(n, 200, f'{{"id": {i}}}') for n, i in enumerate(ids)]
            B.enrich(spark, store, spark.createDataFrame(bodies, "event_id bigint, status bigint, body string"), D1)
    assert seen == list(range(1, 31))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.range(400_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 7).alias("timestamp"))
    with_size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(with_size, "1m")
    try:
        out = load_incremental_fact(
            store, "marts", "f", rows, lambda r: r.select("k", "v", F.timestamp_seconds("timestamp").alias("ts")), ["k"], "ts", buckets=1
        )
    finally:
        spark.conf.unset(with_size)
    files = list((tmp_path / "marts" / "f" / "v1").rglob("part-*.parquet"))
    assert len({f.parent for f in files}) == 1 and len(files) > 4  # one bucket, several tasks
    assert out.count() == 400_000 and out.select("k").distinct().count() == 400_000


def test_the_number_of_buckets_follows_the_first_load(spark, monkeypatch):
    monkeypatch.setattr(loads, "BUCKET_BYTES", 1000)
    assert loads.bucket_number(spark.range(10)) == 256
    assert loads.bucket_number(spark.range(100_000)) == 800
    assert loads.bucket_number(spark.range(10**9)) == loads.MOST_BUCKETS
