import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import language_id as L
from tests.llm.conftest import frame, odd_rows


def test_held_out_accuracy(spark, docs):
    rows = docs.withColumn("held_out", F.coalesce(L.remainder() == 2, F.lit(False)))
    out = L.identify(rows, L.train(docs)).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for h, i in zip(out.held_out, out.doc_id, strict=True))
    held = out[out.held_out]
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()


def test_labels_of_held_out_rows_do_not_matter(spark, docs):
    spoiled = docs.withColumn("lang", F.when(L.remainder() == 2, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (L.identify(docs.select("doc_id", "text"), L.train(d)).orderBy("doc_id").collect() for d in (docs, spoiled))
    assert a == b


def test_odd_rows(spark, odd):
    out = L.identify(odd, L.train(odd))
    assert len(out.collect()) == len(odd_rows()) and {"lang_pred", "score"} < set(out.columns)
    for r in out.collect():
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und" and r.score == 0) if none else r.lang_pred in ("en", "de")
    kept = L.keep_known(odd, least_score=0.0)
    assert kept.columns == odd.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in odd_rows())


@pytest.mark.parametrize("langs,want", [((), ("und", 0.0)), (("fr",), ("fr", 1.0))])
def test_no_language_and_one(spark, langs, want):
    df = frame(spark, [(i, f"some text {i}", langs[0] if langs else None, "s") for i in range(1, 9)])
    assert {(r.lang_pred, r.score) for r in L.identify(df, L.train(df)).collect()} == {want}


def test_document_frequencies_cover_all_rows(spark):
    texts = ["ab", "ab ab", "b", None, "1"]
    n, df = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    want = np.zeros(L.BUCKETS, int)
    for t in texts:
        want[L.ngram_counts(t)[0]] += 1
    assert n == 3 and (df == want).all()


def test_penalty_leaves_weights_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        found = np.unique(rng.integers(0, 400, 30)) + (i % 2) * 200
        rows.append((found, np.full(len(found), len(found) ** -0.5), i % 2))
    w = L.fit_ftrl(rows, 2)
    assert (w != 0).any(axis=1).sum() < 700 and w[600:-1].any() == False  # noqa: E712
    logits, labels = rng.normal(size=(500, 2)) * 8, rng.integers(0, 2, 500)
    assert L.fit_temperature(logits, labels) > 3  # labels are noise: scores must come down


def test_empty(empty):
    assert L.identify(empty, L.train(empty)).collect() == [] and L.keep_known(empty).collect() == []


def plain_vector(text, idf=None):
    """Bucket -> count, or TF-IDF weight, of all n-grams of 1 to 3 characters, one by one."""
    s = " " + re.sub("\0+", " ", "".join(c if c.isalpha() else "\0" for c in (text or "").lower())) + " "
    if not any(c.isalpha() for c in s):
        return {}
    mix, full, counts = 0x9E3779B97F4A7C15, (1 << 64) - 1, {}
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            c = [ord(x) for x in s[i : i + n]]
            x = c[0] if n == 1 else c[0] << 21 | c[1]
            x = (x * mix + c[2]) * mix & full if n == 3 else x
            bucket = ((x + n - 1) * mix & full) >> 64 - L.BUCKET_BITS
            counts[bucket] = counts.get(bucket, 0) + 1
    if idf is None:
        return counts
    weights = {b: (1 + math.log(c)) * idf(b) for b, c in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {b: w / norm for b, w in weights.items()}


def plain_softmax(z):
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def plain_model(rows):
    """``predict`` of a model learned from ``(text, lang)`` in this order, with dictionaries and loops."""
    vectors = [plain_vector(t) for t, _ in rows]
    n_docs, df = sum(bool(v) for v in vectors), {}
    for v in vectors:
        for b in v:
            df[b] = df.get(b, 0) + 1
    idf = lambda b: math.log((1 + n_docs) / (1 + df.get(b, 0))) + 1
    langs = sorted({lang for _, lang in rows})
    data = [(plain_vector(t, idf), langs.index(lang)) for t, lang in rows if plain_vector(t)]
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= L.L1:
            return 0.0
        return -(z[key] - math.copysign(L.L1, z[key])) / ((L.BETA + math.sqrt(n.get(key, 0.0))) / L.ALPHA + L.L2)

    def logits(v):
        return [sum(x * weight((b, k)) for b, x in v.items()) + weight((None, k)) for k in range(len(langs))]

    for _ in range(L.EPOCHS):
        for v, label in (d for i, d in enumerate(data) if i % 5):
            p = plain_softmax(logits(v))
            old = {(b, k): weight((b, k)) for b in [*v, None] for k in range(len(langs))}
            for (b, k), w in old.items():
                g = (1.0 if b is None else v[b]) * (p[k] - (k == label))
                before = n.get((b, k), 0.0)
                z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / L.ALPHA * w
                n[b, k] = before + g * g
    back = [(logits(v), label) for v, label in data[::5]]
    loss = lambda t: -sum(math.log(max(plain_softmax([x / math.exp(t) for x in s])[k], 1e-12)) for s, k in back) / len(back)
    low, high, ratio = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    heat = math.exp((low + high) / 2)

    def predict(text):
        v = plain_vector(text, idf)
        p = plain_softmax([x / heat for x in logits(v)]) if v else [0.0]
        return (langs[p.index(max(p))], max(p)) if v else ("und", 0.0)

    return predict


def test_predictions_equal_a_plain_recomputation(spark, docs):
    some = [(r.doc_id, r.text[:400], r.lang, r.source) for r in docs.orderBy("doc_id").limit(60).collect()]
    df = frame(spark, [*some, (9001, "  ... ", "en", None), (9002, None, "de", None), (None, "keine Kennung", "de", None), (9003, "Ünï 日本 x", None, None)])
    learn = df.where((L.remainder() != 2) & F.col("lang").isNotNull()).orderBy(F.xxhash64("doc_id"), "lang", "text").collect()
    predict = plain_model([(r.text, r.lang) for r in learn if r.text is not None])
    for r in L.identify(df, L.train(df)).collect():
        lang, score = predict(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-6), r.text
