import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import suffix_dedup as S
from tests.llm.conftest import frame, odd_rows, words


def brute(rows):
    """Order by id (NULL first), then digest; equal (id, text) rows are one document."""
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    order = sorted({(i is not None, i or 0, sha(t)): (t or "").encode() for i, t, *_ in rows}.items())
    seen, out = set(), {}
    for key, raw in order:
        mark = bytearray(len(raw))
        for s in range(len(raw) - S.LENGTH + 1):
            w = raw[s : s + S.LENGTH]
            if w in seen:
                mark[s : s + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(w)
        kept = bytes(c for c, m in zip(raw, mark, strict=True) if not m)
        runs = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        out[key] = (len(raw), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return sorted((repr(i), *out[i is not None, i or 0, sha(t)]) for i, t, *_ in rows)


def got(df):
    return sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages(n=60, seed=3):
    """Documents that share passages, some many times, some overlapping, some at other offsets."""
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(18, 70)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [words(rng, rng.randint(0, 30)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, 3), p[a : len(p) - rng.randint(0, len(p) // 3)])
        rows.append((i, "é".join(parts), "en", "s"))
    return rows


@pytest.fixture(params=["odd", "passages"])
def rows(request):
    return odd_rows() if request.param == "odd" else passages()


@pytest.mark.parametrize("chunk,block", [(2 << 20, 4096), (700, 4096), (300, 3)])
def test_against_brute_force(spark, rows, chunk, block, monkeypatch):
    """Small chunks leave all repeats to the interval trees (and cut long texts); small blocks to the comparison across blocks."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "BLOCK", block)
    df = frame(spark, rows).repartition(4)
    # The tasks see the constants of their own import: run the scan and the numbering with the patched ones here.
    monkeypatch.setattr(S, "anchors", lambda d: spark.createDataFrame(_scan(d, chunk), S.ANCHORS))
    monkeypatch.setattr(S, "partnered", lambda d: spark.createDataFrame(_partners(d, block), S.ANCHORS + ", block long"))
    assert got(S.remove_repeats(df)) == brute(rows)


def _scan(d, chunk):
    out = []
    for r in d.collect():
        raw = r.text.encode()
        for at in range(0, max(len(raw) - S.LENGTH + 1, 0), chunk):
            part = raw[at : at + chunk + S.LENGTH - 1]
            out += list(zip(*(c.tolist() for c in S.scan_chunk([(r.doc, at, part)])), strict=True))
    return out


def _partners(d, block):
    rows = sorted(map(tuple, d.collect()), key=lambda r: r[0])
    anchors = [r for r in rows if r[2] >= 0]
    size, seen, out = pd.Series([r[0] for r in anchors]).value_counts(), {}, [(*r, 0) for r in rows if r[2] < 0]
    for r in anchors:
        seen[r[0]] = seen.get(r[0], -1) + 1
        if size[r[0]] > 1:
            out.append((*r, seen[r[0]] // block))
    return out


def test_real_scan_and_numbering(spark):
    rows = odd_rows() + [(1000 + i, t, a, b) for i, t, a, b in passages(200, 5)]
    assert got(S.remove_repeats(frame(spark, rows).repartition(6))) == brute(rows)


def test_batches_carry_over_in_the_numbering(spark, monkeypatch):
    rng = np.random.default_rng(1)
    data = [(int(g), i, 1 << 16) for i, g in enumerate(rng.integers(0, 400, 3000))] + [(5, 1, -1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = S.partnered(spark.createDataFrame(data, S.ANCHORS)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    n = pd.Series([g for g, _, p in data if p >= 0]).value_counts()
    assert sorted(map(tuple, out)) == sorted((*r, 0) for r in data if r[2] < 0 or n[r[0]] > 1)


def test_intervals_against_all_ranges():
    rng = random.Random(2)
    for _ in range(200):
        keys = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 9)))
        lcp = [S.common(a, b) for a, b in zip(keys, keys[1:], strict=False)]
        want = set()
        for i in range(len(lcp)):
            for j in range(i, len(lcp)):
                h = min(lcp[i : j + 1])
                if h >= 1 and (i == 0 or lcp[i - 1] < h) and (j + 1 == len(lcp) or lcp[j + 1] < h):
                    want.add((h, i, j + 1))
        found = list(S.intervals(keys, 1))
        assert set(found) == want and len(found) == len(want)


def test_groups_hold_every_occurrence_and_cannot_be_extended(spark):
    rng = random.Random(9)
    p = words(rng, 40)[:200]
    ends = [(words(rng, 4), words(rng, 4)) for _ in range(5)]
    rows = [(i, a + "#" + p + "#" + b, "en", "s") for i, (a, b) in enumerate(ends)]
    rows.append((9, words(rng, 3) + "%" + p[20:150] + "%" + words(rng, 3), "en", "s"))
    # One document per task: no repeat is settled inside a chunk.
    found = S.maximal_repeat_groups(frame(spark, rows).repartitionById(10, F.col("doc_id").cast("int"))).toPandas()
    text = {i: t.encode() for i, t, *_ in rows}
    groups = found.groupby(["gram", "repeat"])
    assert len(groups) > 0
    sizes = set()
    for _, g in groups:
        length = g["length"].iloc[0]
        strings = {text[d][s : s + length] for d, s in zip(g["doc_id"], g["start"], strict=True)}
        assert length >= S.LENGTH and len(strings) == 1
        s = strings.pop()
        assert len(g) == sum(t.count(s) for t in text.values())
        sizes.add(len(g))
    assert {5, 6} <= sizes


def test_equal_documents_are_not_scanned(spark, monkeypatch):
    """Copies are known by digest: their texts need no anchors, however many there are."""
    rng = random.Random(4)
    texts = [words(rng, 60) for _ in range(4)]
    rows = [(i, texts[i % 4] if i < 20 else words(rng, 60), "en", "s") for i in range(24)]
    scanned, anchors = [], S.anchors
    monkeypatch.setattr(S, "anchors", lambda d: (scanned.extend(r.doc for r in d.collect()), anchors(d))[1])
    assert got(S.remove_repeats(frame(spark, rows))) == brute(rows)
    assert sorted(scanned) == [0, 1, 2, 3, 20, 21, 22, 23]


@pytest.mark.parametrize("line", [70, 300])
def test_hot_grams_compare_few_strings(spark, line, monkeypatch):
    """A line in very many documents: equal contexts meet as one, and contexts that differ around a short line give no strings."""
    rng = random.Random(line)
    hot = words(rng, 60)[:line]
    rows = [(i, words(rng, 40) + "\n" + hot + "\n" + words(rng, 40), "en", "s") for i in range(40)]
    rows += [(40 + i, f"same before {hot} same after, for {100 - line // 3} bytes and more of them", "en", "s") for i in range(3)]
    sizes, kept = {}, S.stored

    def counted(df, name, *args):
        out = kept(df, name, *args)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(S, "stored", counted)
    monkeypatch.setattr(S, "anchors", lambda d: spark.createDataFrame(_scan(d, 2 << 20), S.ANCHORS))
    monkeypatch.setattr(S, "partnered", lambda d: spark.createDataFrame(_partners(d, 3), S.ANCHORS + ", block long"))
    assert got(S.remove_repeats(frame(spark, rows))) == brute(rows)
    assert sizes["hot-contexts"] >= 40
    if line == 300:  # the line holds whole contexts, each of which every document has
        assert sizes["hot-heads"] < sizes["hot-contexts"] / 2
    else:
        assert sizes["hot-shared"] < sizes["hot-heads"] / 4


def test_contexts_are_the_bytes_of_the_runs(spark):
    """Cut by place in bytes, also in a text of many bytes to a character and of many anchors."""
    rng = random.Random(8)
    text = "é€𝄞".join(words(rng, 12) for _ in range(400))
    raw = text.encode()
    found = [(g, 0, p, False) for g, _, p in _scan(frame(spark, [(7, text, "", "")]).withColumnRenamed("doc_id", "doc"), 1 << 20) if p >= 0]
    kind = "doc long, text string, anchors array<struct<gram: long, block: long, place: long, hot: boolean>>"
    texts = spark.createDataFrame([(7, text, found), (8, "x", [])], kind)
    rows = S.contexts_of(texts).collect()
    assert len(rows) == len(found) > 200 and {r.doc for r in rows} == {7}
    for r, (g, _, p, _) in zip(sorted(rows, key=lambda r: r["at"]), sorted(found, key=lambda f: f[2] >> 16), strict=True):
        first = (p >> 16) - (p >> 8 & 255)
        assert (r.gram, r["at"], r["first"]) == (g, p >> 16, first)
        assert r.bytes == raw[first : first + (p & 255) + S.LENGTH]
    assert S.contexts_of(texts, hot_only=True).count() == 0


def test_empty(empty):
    assert S.remove_repeats(empty).collect() == []
