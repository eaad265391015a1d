import hashlib
from collections import Counter

import pytest

from strata.llm.exact_dedup import deduplicate, exact_dedup, heavy_digests, digests
from tests.llm.conftest import odd_rows


def brute(rows):
    """Per row (doc_id, keep_id, group_size, sha), and how many of each (id, sha) stay."""
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out, kept = Counter(), {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, sha = max(known) if known else None, hashlib.sha256(t.encode()).hexdigest()
        for i in ids:
            out[i, keep, len(ids), sha] += 1
        kept[sha] = keep
    return out, kept


@pytest.mark.parametrize("min_heavy", [2, 32])
def test_against_brute_force(odd, min_heavy):
    """min_heavy 2 sends every group of copies down the broadcast side, 32 none."""
    want, kept = brute(odd_rows())
    got = exact_dedup(odd, min_heavy=min_heavy).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    stays = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in stays) == sorted(kept)
    assert all(r.doc_id == kept[r.text_sha256] for r in stays)


def test_hot_digest_is_named_and_bounded(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    heavy = heavy_digests(digests(df)).collect()
    assert [(r.keep_id, r.group_size, r.keep_rows) for r in heavy] == [(29_997, 10_000, 1)]
    assert exact_dedup(df).where("kept").count() == 20_001


def test_deduplicate_keeps_one_whole_row_each(odd):
    left = deduplicate(odd)
    assert left.columns == odd.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in odd_rows()})


def test_empty(empty):
    assert exact_dedup(empty).collect() == [] and deduplicate(empty).collect() == []
