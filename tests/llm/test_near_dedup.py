import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import near_dedup
from strata.llm.components import components
from strata.llm.near_dedup import Threshold, deduplicate, near_groups, shingles, signature
from tests.llm.conftest import frame, odd_rows, words


def shingle_set(text, k):
    """Plain shingles, without hashes."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    ws = [w for w in lower.split(" ") if w]
    return {tuple(ws[i : i + k]) for i in range(max(len(ws) - k + 1, 1))} if ws else set()


def brute(rows, k, num, den):
    rows = [(i, shingle_set(t, k)) for i, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(range(len(rows)), 2):
        (i, a), (j, b) = rows[x], rows[y]
        if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
            root[find(x)] = find(y)
    best = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            best[find(x)] = min(i, best.get(find(x), i))
    return sorted((repr(i), len(s), repr(best.get(find(x)))) for x, (i, s) in enumerate(rows))


def got(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("k,num", [(3, 85), (5, 80), (1, 50)])
def test_against_brute_force(odd, k, num):
    out = near_groups(odd, k, num)
    assert got(out) == brute(odd_rows(), k, num, 100)
    shared = {30}  # different texts under one id
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out.collect() if r.doc_id not in shared)


def family(n, edits, seed):
    """Near copies of one text, each with its own words changed."""
    rng = random.Random(seed)
    base = words(rng, 120).split()
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(len(own)), rng.randint(0, edits)):
            own[at] = words(rng, 1) + str(i)
        out.append((i, " ".join(own), "en", "s"))
    return out


@pytest.mark.parametrize("edits", [4, 12])
def test_families_with_and_without_depth(spark, edits):
    """At depth 1 with tiny leaves everything goes through the left-over families; both ways must agree with brute force."""
    rows = family(150, edits, 7) + [(1000 + i, t, a, b) for i, t, a, b in family(40, edits, 8)]
    df = frame(spark, rows)
    want = brute(rows, 3, 85, 100)
    assert got(near_groups(df, 3, 85)) == want
    assert got(near_groups(df, 3, 85, depth=1, leaf=2)) == want
    assert got(near_groups(df, 3, 85, depth=1, leaf=40)) == want


def left_over(spark, rows, k):
    """All texts in one node that stayed large, each a group of its own: the arguments of ``rare_candidates``."""
    df = frame(spark, rows)
    texts = df.select(F.col("doc_id").alias("rep"), "text")
    node = near_dedup.sketches(df, k).select(F.lit(0).cast("long").alias("key"), F.col("doc_id").alias("rep"), "n", "bits")
    return node, df.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("component")), texts


def template_family(n, shared, own, seed=5):
    """Texts of ``shared`` words of one template followed by ``own[i % len(own)]`` words of their own."""
    rng = random.Random(seed)
    base = words(rng, shared)
    return [(i, f"{base} " + " ".join(f"{i}x{j}" for j in range(own[i % len(own)])), "en", "s") for i in range(n)]


@pytest.mark.parametrize("own", [[45], [40, 47, 55, 64, 90]])
def test_a_template_below_the_threshold_joins_nobody(spark, own):
    """No pair of the family links, and none is compared, whatever the mix of sizes."""
    pairs, lists = near_dedup.rare_candidates(*left_over(spark, template_family(300, 200, own), 3), 3, Threshold(85, 100))
    assert pairs.count() == 0 and lists.count() == 0


@pytest.mark.parametrize("k,num,leaf", [(3, 85, 400), (3, 85, 4), (1, 60, 400), (5, 80, 400)])
def test_rare_shingles_find_every_link(spark, k, num, leaf):
    """Each link is a candidate, or both its texts are in one large list; sizes from a few words to hundreds."""
    rng = random.Random(num + leaf)
    rows = family(60, 14, num) + [(500 + i, t, a, b) for i, t, a, b in template_family(40, 120, list(range(0, 60, 3)))]
    for i in range(60):  # chains of growing texts, some of a few words
        rows.append((1000 + i, " ".join(f"c{i % 3}x{j}" for j in range(2 + i // 3 * (1 + i % 3))) + rng.choice(["", " end"]), "en", "s"))
    at_least = Threshold(num, 100)
    pairs, lists = near_dedup.rare_candidates(*left_over(spark, rows, k), k, at_least, leaf)
    found = {(r.a, r.b) for r in pairs.collect()}
    for r in lists.groupBy("key").agg(F.collect_set("rep").alias("reps")).collect():
        found.update(itertools.combinations(sorted(r.reps), 2))
    sets = {i: shingle_set(t, k) for i, t, *_ in rows}
    links = {(x, y) for x, y in itertools.combinations(sorted(sets), 2) if 100 * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y])}
    assert len(links) > 100 and links <= found


def threshold_pairs(families, pairs, common, own, edits, seed=1):
    """Pairs of texts of similarity (common + own) / (common + own + 2 * edits) on single words, ids 2i and 2i + 1, in
    families whose other texts share only the ``common`` words."""
    rng, out = random.Random(seed), []
    for f in range(families):
        for p in range(pairs):
            for side in range(2):
                text = [f"t{f}x{i}" for i in range(common)] + [f"o{f}x{p}x{i}" for i in range(own)]
                text += [f"e{f}x{p}x{side}x{i}" for i in range(edits)]
                rng.shuffle(text)
                out.append((len(out), " ".join(text), "en", "s"))
    return out


class Seen(Exception):
    pass


@pytest.mark.parametrize("num,common,edits", [(80, 32, 4), (85, 34, 3)])
def test_trees_hold_pairs_at_the_threshold_together(spark, monkeypatch, num, common, edits):
    """Nodes of more than one text count as large here, so every tree goes on to its deepest level."""
    held = set()

    def watched(*args):
        left_over = candidates(*args)[1].groupBy("key").agg(F.collect_set("rep").alias("reps"))
        held.update(i for r in left_over.collect() for i in r.reps if i % 2 == 0 and i + 1 in r.reps)
        raise Seen

    candidates = near_dedup.candidates
    monkeypatch.setattr(near_dedup, "candidates", watched)
    with pytest.raises(Seen):
        near_groups(frame(spark, threshold_pairs(3000, 1, common, 0, edits)), 1, num, leaf=1)
    assert 3000 - len(held) <= 3


def test_isolated_pairs_at_the_threshold_among_loose_families(spark):
    """1,200 pairs of similarity 0.8, in families of 150 texts of similarity 0.5."""
    rows = threshold_pairs(16, 75, 30, 10, 5)
    assert {r.doc_id: r.component_id for r in near_groups(frame(spark, rows), 1, 80, leaf=16).collect()} == {i: i - i % 2 for i, *_ in rows}


@pytest.mark.parametrize("num", [10, 50, 80, 85, 95, 100])
def test_the_number_of_trees_follows_from_the_threshold(num):
    for depth in (1, 6):
        trees, levels = Threshold(num, 100).forest(depth)
        assert levels <= depth and (1 - (num / 100) ** levels) ** trees <= near_dedup.MISS
        assert trees <= near_dedup.MOST_TREES or levels == 1
    assert Threshold(80, 100).forest() == (31, 6) and Threshold(85, 100).forest() == (20, 6)


def test_deduplicate_keeps_columns(odd):
    left = deduplicate(odd)
    assert left.columns == odd.columns
    ids = {r.doc_id for r in left.collect()}
    assert 1 in ids and not ids & {10, 11, 12, 13} and None in ids


def test_block_comparison_in_small_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 90), np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(x, y)) for y in sets[15:]] for x in sets[:15]]
    size = np.array([len(s) for s in sets])
    for cells in (1, 300, 10_000, 10**7):
        monkeypatch.setattr(near_dedup, "CELLS", cells)
        assert near_dedup._overlaps(sets[:15], sets[15:]).tolist() == want
        tiles = list(near_dedup._tiles(np.arange(40), size))
        assert np.concatenate(tiles).tolist() == list(range(40))
        assert all(len(t) == 1 or len(t) * size[t].sum() <= cells for t in tiles)


def test_signature_estimates_similarity():
    members = np.random.default_rng(1).integers(0, 2**63, 1100, np.uint64)
    a, b = np.unique(members[:1000]), np.unique(members[100:])
    alike = np.mean(signature(a) == signature(b))
    assert abs(alike - 900 / 1100) < 0.2 and not Threshold(85, 100).links(a, b) and Threshold(80, 100).links(a, b)


def test_shingles_of_long_text_equal_plain_ones():
    text = words(random.Random(3), 30_000)
    assert len(shingles(text, 3)) == len(shingle_set(text, 3))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(5, 5)]
    random.Random(1).shuffle(path)
    out = {r.id: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(80)}


def test_empty(empty):
    assert near_groups(empty).collect() == [] and deduplicate(empty).collect() == []
