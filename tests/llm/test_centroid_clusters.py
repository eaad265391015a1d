import hashlib
import math
import random

import numpy as np
import pytest

from strata.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, v string"


def brute(vectors, centroids):
    apart = ((vectors[:, None, :].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
    best = [min(range(len(centroids)), key=lambda c: (row[c], c)) for row in apart]
    return best, [int(row[c]) for row, c in zip(apart, best, strict=True)]


@pytest.mark.parametrize("spread", [1, 2, 30, 5000, 1 << 26])
@pytest.mark.parametrize("k,dimensions", [(1, 3), (2, 1), (7, 5), (40, 64)])
def test_walk_finds_the_nearest_with_ties_to_the_smaller_number(k, dimensions, spread):
    rng = np.random.default_rng(k * spread)
    centroids = rng.integers(-spread, spread + 1, (k, dimensions))
    vectors = rng.integers(-spread, spread + 1, (60, dimensions)).astype(np.int32)
    vectors[:k] = centroids[:60][: len(vectors[:k])]  # distance 0, and repeated centroids at small spreads
    best, distance, _ = cc.SortedLists(centroids).nearest(vectors)
    assert (best.tolist(), distance.tolist()) == brute(vectors, centroids)


def test_the_threshold_spares_exact_distances():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-10000, 10000, (40, 4))
    vectors = (centroids[rng.integers(0, 40, 500)] + rng.integers(-20, 20, (500, 4))).astype(np.int32)
    best, distance, taken = cc.SortedLists(centroids).nearest(vectors)
    assert (best.tolist(), distance.tolist()) == brute(vectors, centroids)
    assert taken < 500 * 40 / 4


def rows(seed, n, dimensions):
    rng = random.Random(seed)
    out = [(i, [rng.uniform(-1, 1) for _ in range(dimensions)], "x", "y", "z") for i in range(n)]
    out += [(i + n, out[3][1], "x", None, "z") for i in range(n // 2)]  # a third of all rows are copies
    bad = [None, [], [0.5] * (dimensions - 1), [0.5] * (dimensions + 1)]
    bad += [[v] + [0.1] * (dimensions - 1) for v in (None, math.nan, math.inf, -math.inf)]
    out += [(10_000 + i, b, None, None, None) for i, b in enumerate(bad)]
    return [*out, out[0], (None, [0.25] * dimensions, None, None, None)]


@pytest.mark.parametrize("n,k,dimensions", [(90, 6, 5), (4, 40, 3)])
def test_clusters_equal_a_plain_version_however_rows_are_dealt(spark, n, k, dimensions):
    data = rows(n, n, dimensions)
    usable = [(i, np.floor(256 * np.array(x, np.float32).astype(float)).astype(np.int64)) for i, x, *_ in data
              if x is not None and len(x) == dimensions and all(c is not None and math.isfinite(c) for c in x)]
    vectors = np.array([v for _, v in usable])
    start = sorted(usable, key=lambda u: (hashlib.sha256(f"2:{'' if u[0] is None else u[0]}".encode()).hexdigest(), u[1].tolist()))
    centroids = np.array([v for _, v in start[:k]])
    for _ in range(5):
        best, _ = brute(vectors, centroids)
        for c in set(best):
            mine = vectors[[i for i, b in enumerate(best) if b == c]]
            centroids[c] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    best, distance = brute(vectors, centroids)
    expected = sorted(((i, b, d) for (i, _), b, d in zip(usable, best, distance, strict=True)), key=str)
    for parts in (1, 7):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        seen = []
        out, final = cc.cluster(df, k=k, dimensions=dimensions, progress=lambda step, c, seen=seen: seen.append(step))
        assert final.tolist() == centroids.tolist() and seen == list(range(6))
        assert sorted(map(tuple, out.collect()), key=str) == expected
        per = {r["_cluster"]: r for r in cc.summary(out, final).collect()}
        assert set(per) == set(best) and {r["inertia"] for r in per.values()} == {sum(distance)}
        assert all(r["cluster_inertia"] == sum(d for b, d in zip(best, distance, strict=True) if b == c) for c, r in per.items())


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], None, None, None)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        cc.integer_vectors(df, "vec_id", "embedding", 2).collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = cc.query(spark, str(tmp_path))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.count() == 0
