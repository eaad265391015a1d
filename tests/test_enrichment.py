import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import build as B
from strata.plans import enrichment
from strata.plans.attempts import due_keys
from strata.sources.storage import TableStore

SCHEMA = "event_id bigint, status bigint, body string"
T1 = dt.datetime(2024, 1, 1, 6)
T2 = dt.datetime(2024, 1, 2, 6)


def test_parse_skips_failures_and_nulls_missing_fields(spark):
    resp = spark.createDataFrame(
        [
            (1, 200, '{"id": 5, "title": "Heat", "runtime": 170, "popularity": 1.5}'),
            (2, 404, "not json"),
            (3, 500, "{}"),
        ],
        SCHEMA,
    )
    rows = enrichment.parse_payloads(resp, "event_id").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.tmdb_id, r.title, r.runtime, r.popularity, r.overview, r.budget) == (5, "Heat", 170, 1.5, None, None)
    assert r.raw_json.startswith('{"id": 5')


def test_parse_invalid_json_raises(spark):
    resp = spark.createDataFrame([(1, 200, "{broken")], SCHEMA)
    with pytest.raises(Exception):
        enrichment.parse_payloads(resp).collect()


def test_payload_upsert_latest_wins_and_load_time(spark):
    target = enrichment.empty_target(spark)
    first = spark.createDataFrame([(1, 200, '{"id": 5, "title": "A"}'), (2, 200, '{"id": 6, "title": "B"}')], SCHEMA)
    t1 = enrichment.payload_upsert(target, first, T1)
    batch = spark.createDataFrame(
        [(3, 200, '{"id": 5, "title": "A2"}'), (4, 200, '{"id": 5, "title": "A3"}'),
         (5, 200, '{"id": 7, "title": "C"}'), (6, 404, "")],
        SCHEMA,
    )
    t2 = enrichment.payload_upsert(t1, batch, T2)
    got = sorted((r.tmdb_id, r.title, r.loaded_at) for r in t2.collect())
    assert got == [(5, "A3", T2), (6, "B", T1), (7, "C", T2)]
    rep = enrichment.load_report(t1, batch).first().asDict()
    assert rep == {"keys_queried": 4, "movies_fetched": 3, "not_found": 1, "other_errors": 0,
                   "movies_loaded": 3, "without_id": 0, "keys_inserted": 1, "keys_updated": 1}


def test_empty_batch_changes_nothing(spark):
    target = enrichment.payload_upsert(
        enrichment.empty_target(spark), spark.createDataFrame([(1, 200, '{"id": 1}')], SCHEMA), T1
    )
    empty = spark.createDataFrame([], SCHEMA)
    assert enrichment.payload_upsert(target, empty, T2).collect() == target.collect()
    rep = enrichment.load_report(target, empty).first()
    assert rep.keys_queried == 0 and rep.movies_loaded == 0


def test_enrichment_keys_distinct_sorted_non_null(spark):
    dim = spark.createDataFrame([(3,), (1,), (None,), (3,), (2,)], "tmdb_id bigint")
    assert [r.tmdb_id for r in enrichment.enrichment_keys(dim, 2).collect()] == [1, 2]


def test_load_time_defaults_to_current_timestamp(spark):
    resp = spark.createDataFrame([(1, 200, '{"id": 9}')], SCHEMA)
    before = dt.datetime.now() - dt.timedelta(minutes=5)
    r = enrichment.payload_upsert(enrichment.empty_target(spark), resp).first()
    assert r.tmdb_id == 9 and r.loaded_at >= before


def test_parse_can_skip_invalid_bodies(spark):
    resp = spark.createDataFrame([(1, 200, "{broken"), (2, 200, '{"id": 3}')], SCHEMA)
    rows = enrichment.parse_payloads(resp, on_invalid="skip").collect()
    assert [r.tmdb_id for r in rows] == [3]


def test_mistyped_fields_raise_or_are_null_when_skipping(spark):
    for body in ('{"id": 1, "runtime": "90 min"}', '{"id": "abc"}', '{"id": 1, "popularity": [1]}'):
        resp = spark.createDataFrame([(1, 200, body)], SCHEMA)
        with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
            enrichment.parse_payloads(resp).collect()
    resp = spark.createDataFrame([(1, 200, '{"id": 1, "runtime": "90 min"}')], SCHEMA)
    assert [r.runtime for r in enrichment.parse_payloads(resp, on_invalid="skip").collect()] == [None]


def test_responses_without_id_are_rejected_and_counted(spark):
    resp = spark.createDataFrame([(1, 200, '{"id": null, "title": "x"}'), (2, 200, '{"title": "y"}'), (3, 200, '{"id": 4}')], SCHEMA)
    target = enrichment.empty_target(spark)
    for _ in range(2):
        target = enrichment.payload_upsert(target, resp, T1)
    assert [r.tmdb_id for r in target.collect()] == [4]
    rep = enrichment.load_report(enrichment.empty_target(spark), resp).first()
    assert (rep.movies_fetched, rep.movies_loaded, rep.without_id) == (3, 1, 2)


def test_due_keys_never_tried_first_then_oldest(spark):
    ids = spark.createDataFrame([(i,) for i in range(1, 7)], "tmdb_id bigint")
    tries = [(1, 404, T2), (1, 500, T1), (2, 404, T1), (3, 500, T2), (3, 404, T2), (9, 200, T1), (None, 404, T1)]
    attempts = spark.createDataFrame(tries, "tmdb_id bigint, status bigint, attempted_at timestamp")
    got = [tuple(r) for r in due_keys(ids, attempts, 10).collect()]
    assert got == [(4, None, None), (5, None, None), (6, None, None), (2, 404, T1), (1, 404, T2), (3, 500, T2)]
    assert [r.tmdb_id for r in enrichment.enrichment_keys(ids, 4, ids.where("tmdb_id = 5"), attempts).collect()] == [4, 6, 2, 1]


def test_failed_ids_do_not_hold_up_the_others(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(1, 251).select(F.col("id").alias("tmdb_id")), "marts", "dim_movies")
    seen = []
    for run in range(4):
        ids = [r.tmdb_id for r in B.keys_to_enrich(store, 100).collect()]
        seen.append(ids)
        rows = [(n, 404 if i % 5 else 200, f'{{"id": {i}}}' if i % 5 == 0 else "", i) for n, i in enumerate(ids)]
        resp = spark.createDataFrame(rows, "event_id bigint, status bigint, body string, tmdb_id bigint")
        report = B.enrich(spark, store, resp, dt.datetime(2024, 1, 1 + run))
        assert report["keys_queried"] == 100 and report["movies_loaded"] == sum(i % 5 == 0 for i in ids)
    failed = [i for i in range(1, 251) if i % 5]
    assert seen[0] == list(range(1, 101)) and seen[1] == list(range(101, 201))
    assert seen[2] == [*range(201, 251), *failed[:50]]  # those never tried, then the oldest failures
    assert seen[3] == failed[50:150]
    ledger = B.attempt_ledger(store).read()
    assert ledger.count() == 400 and ledger.where("status = 404").count() == 400 - 50


def test_a_failing_batch_is_recorded_though_nothing_is_loaded(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(1, 4).select(F.col("id").alias("tmdb_id")), "marts", "dim_movies")
    resp = spark.createDataFrame([(1, 404, "", 1), (2, 500, "", None)], "event_id bigint, status bigint, body string, tmdb_id bigint")
    B.enrich(spark, store, resp, T1)
    assert not store.exists("raw", "raw_tmdb_movies")
    assert [r.tmdb_id for r in B.keys_to_enrich(store, 3).collect()] == [2, 3, 1]
    assert [(r.tmdb_id, r.status) for r in B.attempt_ledger(store).read().collect()] == [(1, 404)]


def test_bodies_are_parsed_once(spark, tmp_path, monkeypatch):
    """The intake alone parses; the stored VARIANT is read by the report, the merge and the ledger."""
    calls, parse = [], enrichment.F.parse_json
    monkeypatch.setattr(enrichment.F, "parse_json", lambda c: calls.append(1) or parse(c))
    store = TableStore(spark, str(tmp_path))
    resp = spark.createDataFrame([(1, 200, '{"id": 5, "title": "A"}'), (2, 200, '{"id": null}'), (3, 404, "{bad")], SCHEMA)
    report = B.enrich(spark, store, resp, T1)
    assert len(calls) == 1
    assert (report["movies_loaded"], report["without_id"], report["not_found"]) == (1, 1, 1)
    assert [(r.tmdb_id, r.title, r.raw_json) for r in store.read("raw", "raw_tmdb_movies").collect()] == [(5, "A", '{"id": 5, "title": "A"}')]
    taken = enrichment.intake(resp, "event_id")
    assert dict(taken.dtypes)["doc"] == "variant"
