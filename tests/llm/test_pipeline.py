"""The pipeline against a plain-Python version of each stage on what the stage before kept."""

import os

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from strata.llm import language_id
from strata.llm import sentencepiece_codec as codec
from strata.llm.common import scratch, stored
from tests.conftest import SF001
from tests.llm.test_mixing import brute_mix, n_words
from tests.llm.test_near_dedup import brute as brute_near


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_stages(spark, table, request):
    docs = request.getfixturevalue(table)
    done = [docs]
    for name, stage in corpus_pipeline.STAGES:
        done.append(stored(stage(spark, done[-1], SF001), f"test-{name}"))
    start, known, exact, near, mixed, pieces = done
    for df in (known, exact, near, mixed):
        assert df.columns == docs.columns

    model = language_id.train(start)
    want = [r for r in rows(start) if model.predict(r[1])[0] != "und" and model.predict(r[1])[1] >= language_id.LEAST_SCORE]
    assert sorted(map(repr, rows(known))) == sorted(map(repr, want))

    best = {}
    for r in rows(known):
        if r[1] not in best or (r[0] is not None and (best[r[1]] is None or r[0] > best[r[1]])):
            best[r[1]] = r[0]
    assert sorted((r[1], repr(r[0])) for r in rows(exact)) == sorted((t, repr(i)) for t, i in best.items())

    groups = {i: g for i, _, g in brute_near(rows(exact), 5, 80, 100) if i == g}
    assert {repr(r[0]) for r in rows(near)} - {"None"} == set(groups) - {"None"}

    taken = {i: t for i, *_, t in brute_mix(rows(near), 64)}
    words = {}
    for i, t, *_ in rows(mixed):
        words[repr(i)] = words.get(repr(i), 0) + n_words(t)
    ids = [repr(r[0]) for r in rows(near)]
    once = {i for i in ids if ids.count(i) == 1}
    assert {i: n for i, n in words.items() if i in once} == {i: t for i, t in taken.items() if t and i in once}

    library = sentencepiece.SentencePieceProcessor(model_file=codec.model_file())
    got = sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u2").tolist(), r.round_trip) for r in pieces.collect())
    assert got == sorted((repr(i), library.encode(t), True) for i, t, *_ in rows(mixed))


def test_run_and_empty(spark, empty):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF001), "test-empty")
    assert docs.collect() == []
    out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0 and out.where("NOT round_trip").count() == 0


def test_a_run_leaves_its_last_result_only(spark, tmp_path):
    before = set(os.listdir(root(spark)))
    out = corpus_pipeline.run(spark, SF001)
    left = set(os.listdir(root(spark))) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-sentencepiece")
    assert out.count() > 0


def root(spark):
    return scratch(spark, "x").rpartition("/")[0].removeprefix("file:")
