import hashlib

import numpy as np
import pytest

from strata.llm import token_shards as T
from strata.llm.common import scratch
from tests.llm.conftest import odd_rows


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_one_and_depends_on_the_key(size):
    x = np.arange(size)
    p = T.Permutation(size)
    assert sorted(p.forward(x)) == list(range(size)) and (p.inverse(p.forward(x)) == x).all()
    if size >= 64:
        assert (p.forward(x) != T.Permutation(size, "other").forward(x)).any() and (p.forward(x) != x).any()


def texts_of(records):
    path, pattern = T.vocabulary()
    with open(path, "rb") as file:
        encoding = T.encoding(file.read(), pattern)
    out = {}
    for (doc, first), g in records.sort_values("chunk").groupby([records["doc_id"].fillna(-1), "first"]):
        ids = np.concatenate([np.frombuffer(b, "<u2") for b in g["ids"]])
        assert ids[-1] == T.END and (ids[:-1] < T.END).all() and (np.diff(g["chunk"]) == 1).all()
        out[doc, first] = encoding.decode(ids[:-1].tolist())
    return out


@pytest.mark.parametrize("shard_text_bytes", [1 << 26, 4000])
def test_round_trip_of_odd_rows(spark, odd, shard_text_bytes):
    shards = T.write_shards(odd, scratch(spark, "shards-test"), length=64, shard_text_bytes=shard_text_bytes)
    rows = T.slots(T.read_shards(spark, shards)).toPandas().sort_values("slot")
    assert rows["slot"].tolist() == list(range(len(rows))) and (np.diff(rows["position"]) > 0).all()
    assert (rows["shard"].nunique() > 1) == (shard_text_bytes == 4000)
    index = shards.order.inverse(rows["position"].to_numpy())
    assert (index % shards.per_doc == rows["chunk"]).all()
    rows["first"] = index // shards.per_doc
    want = {(i, t or "") for i, t, *_ in odd_rows()}
    assert sorted((-1 if i is None else i, t) for i, t in want) == sorted((d, t) for (d, _), t in texts_of(rows).items())


def test_documents_resume_and_rerun(spark, docs):
    a, b = (T.write_shards(docs, scratch(spark, "shards-test"), shard_text_bytes=100_000) for _ in range(2))
    rows = T.read_shards(spark, a).toPandas()
    stride = T.stride()
    files = [r for r in spark.read.format("binaryFile").load(a.path).collect() if r.length]
    again = {bytes(r.content) for r in spark.read.format("binaryFile").load(b.path).collect() if r.length}
    assert {bytes(r.content) for r in files} == again and len(files) > 1
    for r in files:
        assert r.length % stride == 0
        at = (r.length // stride) // 2  # resume in the middle by arithmetic
        record = bytes(r.content)[at * stride : (at + 1) * stride]
        index, position, doc, chunk, n = T.struct.unpack_from(T.HEADER, record)
        own = rows[(rows["doc_id"] == doc) & (rows["chunk"] == chunk)].iloc[0]
        assert index == at == own["index"] and position == own["position"] and n == own["n_tokens"] and record[-1:] == b"\n"


def test_far_apart_ids(spark):
    df = spark.createDataFrame([(-(2**62), "a"), (2**62, "b"), (0, "c")], "doc_id long, text string")
    shards = T.write_shards(df, scratch(spark, "shards-test"))
    assert sorted(r.doc_id for r in T.read_shards(spark, shards).collect()) == [-(2**62), 0, 2**62] and shards.order.size == 3


def test_empty(spark, empty):
    shards = T.write_shards(empty, scratch(spark, "shards-test"))
    assert T.slots(T.read_shards(spark, shards)).collect() == []


def plain_position(index, size, seed=T.SEED):
    """The place of ``index`` in [0, size) by the keyed rounds, in plain integers."""
    half, word = max(1, -(-(size - 1).bit_length() // 2)), (1 << 64) - 1
    low = (1 << half) - 1
    while True:
        a, b = index >> half, index & low
        for r in range(T.ROUNDS):
            key = int.from_bytes(hashlib.sha256(f"{seed}/{r}".encode()).digest()[:8], "little")
            x = (b ^ key) * 0x9E3779B97F4A7C15 & word
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & word
            a, b = b, a ^ (x ^ x >> 32) & low
        index = a << half | b
        if index < size:
            return index


def test_slots_equal_a_plain_recomputation(spark, docs):
    length = 64
    shards = T.write_shards(docs, scratch(spark, "shards-test"), length=length, shard_text_bytes=100_000)
    path, pattern = T.vocabulary()
    with open(path, "rb") as file:
        encoding = T.encoding(file.read(), pattern)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    first = min(i for i, _ in rows)
    per_doc = -(-(max(len(t.encode()) for _, t in rows) + 1) // length)
    size = (max(i for i, _ in rows) - first + 1) * per_doc
    want = []
    for i, text in rows:
        ids = [*encoding.encode_ordinary(text), T.END]
        for chunk in range(-(-len(ids) // length)):
            part = ids[chunk * length : (chunk + 1) * length]
            want.append((plain_position((i - first) * per_doc + chunk, size), i, chunk, len(part), part))
    want = [(slot, *w) for slot, w in enumerate(sorted(want))]
    got = T.slots(T.read_shards(spark, shards)).collect()
    assert shards.per_doc == per_doc and shards.order.size == size
    have = sorted((r.slot, r.position, r.doc_id, r.chunk, r.n_tokens, np.frombuffer(r.ids, "<u2")[: r.n_tokens].tolist()) for r in got)
    assert have == want


def test_too_many_slots_raise(spark, monkeypatch):
    monkeypatch.setattr(T, "numbered", lambda df, *names: (df, 1 << 60, 4 * T.LENGTH, 1))
    with pytest.raises(ValueError, match="slots"):
        T.write_shards(spark.createDataFrame([(1, "a")], "doc_id long, text string"), scratch(spark, "shards-test"))
