import hashlib

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing as M
from tests.llm.conftest import frame, odd_rows


def n_words(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return len([w for w in (text or "").split(" ") if w])


def brute_targets(sizes, weights=M.WEIGHTS, cap=M.MAX_REPEAT):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest, w = total - sum(cap * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * rest >= cap * sizes[s] * w}
        if not over:
            return {s: float(cap * sizes[s]) if s in full else weight[s] * rest / w for s in names}
        full |= over
        if len(full) == len(names):
            return {s: float(cap * sizes[s]) for s in names}


def brute_quotas(target, house):
    order = {s: i for i, s in enumerate(sorted(target, key=lambda s: (s is None, (s or "").encode())))}
    seats = dict.fromkeys(target, 0)
    for _ in range(house):
        best = max((s for s in target if target[s] > 0), key=lambda s: (target[s] / (2 * seats[s] + 1), -order[s]))
        seats[best] += 1
    return seats


def brute_mix(rows, block):
    docs = [(i, s, n_words(t)) for i, t, _, s in rows]
    sizes = {}
    for _, s, n in docs:
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    quota = brute_quotas(target, -(-sum(sizes.values()) // block))
    out = []
    for s in sizes:
        key = lambda d: (hashlib.md5(f"{M.SEED}:{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] is not None, d[0] or 0, d[2])
        words, at = min(quota[s] * block, M.MAX_REPEAT * sizes[s]), 0
        for i, _, n in sorted((d for d in docs if d[1] == s), key=key):
            passes, rest = divmod(words, sizes[s]) if sizes[s] else (0, 0)
            out.append((repr(i), repr(s), n, sizes[s], target[s], quota[s], passes * n + min(max(rest - at, 0), n)))
            at += n
    return sorted(out)


@pytest.mark.parametrize("block,bucket_rows", [(1, 4096), (16, 2), (64, 4096)])
def test_against_brute_force(spark, block, bucket_rows):
    rows = odd_rows() + [(500 + i, "w " * (7 * i + 1), "en", f"t{i % 9}") for i in range(60)]
    got = M.mix(frame(spark, rows), block_words=block, bucket_rows=bucket_rows).collect()
    want = brute_mix(rows, block)
    have = sorted((repr(r.doc_id), repr(r.source), r.size, r.source_size, r.target, r.quota_blocks, r.taken) for r in got)
    assert have == want
    assert all(r.taken <= M.MAX_REPEAT * r.size for r in got)


def test_targets_add_up_and_shard_quotas_add_up_to_quotas(spark, docs):
    shares = M.targets(M.sizes(docs)).cache()
    rows = shares.collect()
    assert abs(sum(r.target for r in rows) - sum(r.source_size for r in rows)) < 1e-6
    assert all(r.target <= 3 * r.source_size for r in rows)
    whole = {r.source: r.quota for r in M.quotas(shares, 16).collect()}
    assert whole == brute_quotas({r.source: r.target for r in rows}, -(-sum(r.source_size for r in rows) // 16))
    shards = M.shard_quotas(shares, 16, 100).toPandas()
    assert (shards.blocks >= 0).all() and shards.groupby("source").blocks.sum().to_dict() == whole
    per_shard = shards.groupby("shard").blocks.sum().sort_index()
    assert (per_shard.iloc[:-1] == 100).all() and 0 < per_shard.iloc[-1] <= 100


def test_materialised_words_are_the_taken_ones(spark, odd):
    taken = M.mix(odd, block_words=4)
    out = M.materialise(odd, taken)
    assert out.columns == odd.columns
    unique = {r.doc_id: r.taken for r in taken.collect() if r.doc_id not in (None, 30, 31)}
    words = dict.fromkeys(unique, 0)
    for r in out.collect():
        assert r.n_chars == len(r.text)
        if r.doc_id in words:
            words[r.doc_id] += n_words(r.text)
    assert words == unique


def test_one_source_takes_all_once(spark):
    df = frame(spark, [(i, "a b c " * i, "en", None) for i in range(1, 9)])
    assert all(r.taken == r.size == r.doc_id * 3 for r in M.mix(df, block_words=1).collect())


def test_empty_and_wordless(spark, empty):
    assert M.mix(empty).collect() == [] and M.materialise(empty, M.mix(empty)).collect() == []
    df = frame(spark, [(1, None, "en", "a"), (2, " ", "en", "b")])
    assert [(r.size, r.target, r.taken) for r in M.mix(df).collect()] == [(0, 0.0, 0)] * 2
    assert M.materialise(df, M.mix(df)).collect() == []


def test_rows_of_one_id_take_their_own_words(spark):
    rows = [(i, "a b c d e f g h i j", "en", "a") for i in range(40)] + [(i, "v w x y z " * 20, "en", "b") for i in range(40)]
    df = frame(spark, rows)
    taken = M.mix(df, block_words=1)
    words = {}
    for r in M.materialise(df, taken).collect():
        words[r.source] = words.get(r.source, 0) + n_words(r.text)
    assert words == {r.source: r.n for r in taken.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert words["a"] == 1200


@pytest.mark.parametrize("copies", [2, 1024])
def test_rows_that_repeat_all_take_as_much_together(spark, monkeypatch, copies):
    monkeypatch.setattr(M, "COPIES", copies)
    rows = [(1, "one two three", "en", "a")] * 9 + [(None, "four five", None, None)] * 4 + [(i, "w " * i, "de", "c") for i in range(2, 30)]
    df = frame(spark, rows).repartition(4)
    taken = M.mix(df, block_words=4)
    out = M.materialise(df, taken).collect()
    for i in (1, None, 7, 20):
        want = sum(r.taken for r in taken.collect() if r.doc_id == i)
        assert sum(n_words(r.text) for r in out if r.doc_id == i) == want


def test_shards_take_the_stream_block_by_block(spark, docs):
    shares = M.targets(M.sizes(docs)).cache()
    whole = {r.source: r.quota for r in M.quotas(shares, 16).collect()}
    got = {}
    for r in M.shard_blocks(shares, 16, 100).orderBy("shard").collect():
        assert r.first_block == got.get(r.source, 0)  # where the shards before ended
        got[r.source] = r.first_block + r.blocks
    assert got == whole
    for per_shard in (7, 10**6):
        assert {r.source: r.quota_blocks for r in M.mix(docs, block_words=16, per_shard=per_shard).collect()} == whole
