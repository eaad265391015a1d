"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct k-word shingles (64-bit hashes). Documents link if their sets' Jaccard
similarity reaches the threshold; components of the link graph are the groups.

1. One scan sketches every whole text: set size, a digest of the set, minwise values, and one bit
   of each of the first ``BITS``. Equal sets form a class; only its representative goes on, so copies cost nothing further.
2. Trees branch the representatives: at level l of tree t a document goes to the child of its minwise token for (t, l), a
   value that no other tree or level uses, so trees are independent; a row carries the tokens of its own tree. Nodes of at most ``LEAF`` documents are compared
   exhaustively; larger ones branch again. A pair of similarity s survives d levels with chance s ** d, and all trees
   miss it with chance (1 - s ** d) ** trees. The threshold sets the number of trees: it keeps this chance at the deepest
   level, for a pair right at the threshold, to ``MISS`` (closer pairs, and those whose nodes get small earlier, are missed less).
3. A large node also links each member to its least document (a star: one candidate per
   member, not all pairs), which joins big groups early. Nodes still large at the deepest level are
   finished exactly in step 5.
4. Candidates pass two bounds that no true link fails (size ratio; differing bits more than 6.5 standard
   deviations beyond the expected) and are confirmed on the full sets rebuilt from the texts, in rounds: each document's
   closest candidates first, at last all that remain (with those of step 5, if there are any). After a round, candidates inside one group cannot change it
   and leave, so a large group is joined by few of its pairs.
5. Documents of the nodes left over from step 3 that still hold several groups are joined exactly, so no link is lost to the
   depth limit. Shingles that two groups share are ordered by how many documents hold them, the commonest last. Sets of n and n'
   shingles link only with num * (n + n') / (num + den) in common, so the first they share is followed, in either set, by
   that many less one. A document therefore meets those of a size class under its shingles that far from the end only, and
   a family that shares a template meets nowhere unless the template alone could make a link. Small posting lists are
   compared exhaustively as in step 2. Documents of large ones are compared on the full sets, block by block, all outside the
   main group with all others; only that part grows with the square of its family, and it returns links only.

So the one way to miss a link is that of step 2: at most a share ``MISS`` of the pairs at the threshold, fewer of closer ones.

Defined cases: text is lower-cased A-Z only; words are ``[^\\x20\\x09-\\x0D]+``. Fewer than k words: the whole
sequence is one shingle. No words or NULL text: an empty set, linked with nothing, a group of its own. NULL
ids cannot be linked: group NULL, kept. Repeated rows are listed each, in one group. Different texts under one
id are documents of their own, one of which is kept. Texts of any length are hashed whole, in blocks of shingles. Empty tables
give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log, log1p, sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import document_order, documents, filled, own_shuffle, packed, stored
from strata.llm.components import components, stars

#: Chance at most that no tree holds a pair at the threshold together down to the deepest level.
MISS = 1e-4
#: Deepest level, and most trees: a threshold so low that it needs more gets fewer levels, so that more is left to step 5.
DEPTH, MOST_TREES = 6, 32
LEAF = 32
#: Ratio of the sizes at the ends of a size class of step 5.
CLASS = 1.02
#: Minwise values that give a bit to a sketch.
BITS = 64
#: Closest candidates of each document that a round of confirmation takes; None: all that remain.
ROUNDS = (4, None)
#: Documents in a block of step 5, and cells of a matrix in which part of it is compared at once.
FAMILY_BLOCK, CELLS = 512, 4_000_000
#: Shingles, about, that a task of step 5 sends at a time.
TOKENS = 1 << 18
#: Shingles hashed at a time, which bounds memory for very long texts.
BLOCK = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the text's k-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and spaces only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(k, len(words))
    n = len(words) - size + 1
    mixed = np.full(n, size, np.uint64)
    for i in range(size):  # overflow wraps, as it should
        mixed = (mixed ^ mixed >> np.uint64(31)) * _MIX + h[i : i + n]
    return np.unique((mixed ^ mixed >> np.uint64(31)) * _MIX)


@lru_cache(1)
def _multipliers(values: int) -> np.ndarray:
    return np.random.default_rng(20240101).integers(1, 2**63, values, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def signature(members: np.ndarray, values: int = BITS) -> np.ndarray:
    """``values`` minwise values, 32 bits each."""
    best = np.full(values, 2**32 - 1, np.uint64)
    for at in range(0, len(members), BLOCK):
        x = members[None, at : at + BLOCK] * _multipliers(values)
        x ^= x >> np.uint64(29)
        x *= _MIX
        best = np.minimum(best, (x >> np.uint64(32)).min(axis=1))
    return best.astype(np.uint32).view(np.int32)


def sketches(df: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", values: int = BITS) -> DataFrame:
    """``(doc_id, n, digest, bits, sig)`` per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                members = shingles(text, k)
                sig = signature(members, values)
                bits = int.from_bytes(np.packbits(sig[:BITS] & 1).tobytes(), "little", signed=True)
                digest = xxhash.xxh3_128_hexdigest(members.tobytes())
                rows.append((len(members), digest, bits, sig if len(members) else sig[:0]))
            out = pd.DataFrame(rows, columns=["n", "digest", "bits", "sig"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out.astype({"doc_id": "Int64", "n": "int64", "bits": "int64"})

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, digest string, bits long, sig array<int>")


class Threshold:
    """Similarity at least ``num / den``, in integers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        differ = BITS * (1 - num / den) / 2
        self.most_bits = min(BITS, ceil(differ + 6.5 * sqrt(differ * (1 + num / den) / 2)))

    def forest(self, depth: int = DEPTH) -> tuple[int, int]:
        """``(trees, levels)``, of at most ``depth`` levels, that miss a pair at the threshold with chance ``MISS`` at most."""
        for levels in range(depth, 0, -1):
            together = (self.num / self.den) ** levels
            trees = ceil(log(MISS) / log1p(-together)) if together < 1 else 1
            if trees <= MOST_TREES:
                break
        return trees, levels

    def common(self, n: str, least: str) -> Column:
        """Fewest shingles that a set of ``n`` shares with a linked one of ``least`` or more."""
        need = F.expr(f"({self.num} * ({n} + {least}) + {self.num + self.den - 1}) div {self.num + self.den}")
        return F.greatest(need, F.expr(f"({self.num} * greatest({n}, {least}) + {self.den - 1}) div {self.den}"))

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.den * min(len(a), len(b)) < self.num * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def possible(self, x: str, y: str) -> Column:
        """Not ruled out by the set sizes or by the sketches' bits, for sides ``x`` and ``y``."""
        size = F.expr(f"{self.den} * least({x}.n, {y}.n) >= {self.num} * greatest({x}.n, {y}.n)")
        return size & (bits_apart(x, y) <= self.most_bits)


def bits_apart(x: str, y: str) -> Column:
    return F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits")))


def _pairs(left: DataFrame, right: DataFrame, on: Column, at_least: Threshold) -> DataFrame:
    return (
        left.alias("x").join(right.alias("y"), on & (F.col("x.rep") != F.col("y.rep")) & at_least.possible("x", "y"))
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"), bits_apart("x", "y").alias("apart"))
    )


def candidates(reps: DataFrame, at_least: Threshold, depth: int = DEPTH, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``(a, b, apart)``, distinct, and the members ``(key, rep, n, bits)`` of nodes left large."""
    trees, depth = at_least.forest(depth)
    own = F.slice("sig", F.col("tree") * depth + 2, depth - 1)  # the tree's tokens of the deeper levels go along
    rows = reps.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "rep", "n", "bits", "sig").select(
        F.xxhash64("tree", F.get("sig", F.col("tree") * depth)).alias("key"), "rep", "n", "bits", own.alias("tokens")
    )
    leaves, stars = [], []
    for level in range(1, depth + 1):
        nodes = rows.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rep", "n", "bits")).alias("least"))
        nodes = nodes.where("size > 1").withColumn("key", own_shuffle(F.col("key")))  # a common token's node is split
        members = rows.join(nodes, "key").withColumn("tokens", F.when(F.col("size") > leaf, F.col("tokens")))
        members = stored(members, f"nodes-{level}")
        small, large = members.where(F.col("size") <= leaf), members.where(F.col("size") > leaf)
        leaves.append(small.select("key", "rep", "n", "bits"))
        star = large.select(F.struct("rep", "n", "bits").alias("x"), F.col("least").alias("y"))
        star = star.where((F.col("x.rep") != F.col("y.rep")) & at_least.possible("x", "y"))
        stars.append(star.select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"), bits_apart("x", "y").alias("apart")))
        if level == depth or not large.take(1):
            break
        key = F.xxhash64("key", F.get("tokens", F.lit(level - 1)))
        rows = large.select(key.alias("key"), "rep", "n", "bits", "tokens")
    left_over = large.where(F.lit(level == depth)).select("key", "rep", "n", "bits")
    small = union(leaves)  # keys tell the levels apart: one shuffle compares the small nodes of all
    found = _pairs(small, small, F.expr("x.key = y.key AND x.rep < y.rep"), at_least)
    return stored(union([found, *stars]).distinct(), "pairs"), left_over


def confirm(pairs: DataFrame, texts: DataFrame, k: int, at_least: Threshold) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold; ``texts`` has ``(rep, text)``."""
    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = [at_least.links(shingles(x, k), shingles(y, k)) for x, y in zip(batch["ta"], batch["tb"], strict=True)]
            yield batch.loc[np.array(links, bool), ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are in different groups (documents without a group are one each)."""
    ga, gb = (groups.select(F.col("id").alias(c), F.col("component").alias(f"g{c}")) for c in "ab")
    known = pairs.join(ga, "a", "left").join(gb, "b", "left")
    return known.where("coalesce(ga, a) <> coalesce(gb, b)").select(*pairs.columns)


def closest(pairs: DataFrame, n: int) -> DataFrame:
    """The pairs that are among the ``n`` closest candidates of an end."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end"), "a", "b", "apart")
    place = F.row_number().over(Window.partitionBy("end").orderBy("apart", "a", "b"))
    return ends.withColumn("place", place).where(F.col("place") <= n).select("a", "b", "apart").distinct()


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def settle(
    rest: DataFrame, groups: DataFrame | None, links: list[DataFrame], texts: DataFrame, k: int, at_least: Threshold,
    rounds: tuple[int | None, ...] = ROUNDS,
) -> tuple[DataFrame, DataFrame | None]:
    """Confirm candidates in rounds. Adds to ``links``; the candidates between two groups that no round has taken, and the
    groups ``(id, component)``, None without links. A group's least document, which names it, has no row."""
    for n in rounds:
        if not rest.take(1):
            break
        chosen = rest if n is None else stored(closest(rest, n), "closest")
        found = stored(confirm(chosen, texts, k, at_least), "links")
        links.append(found)
        if n is not None:
            rest = rest.join(chosen.select("a", "b"), ["a", "b"], "left_anti")
        if found.take(1):
            groups = stars(union(links))
        if n is not None:
            rest = stored(_across(rest, groups) if groups is not None else rest, "candidates")
    return rest, groups


def _tokens(texts: DataFrame, k: int) -> DataFrame:
    """``(rep, g, n, bits, token)``: a row per distinct shingle of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = batch.drop(columns="text")
            # A document of many shingles goes out by itself, short ones go together.
            for run in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(held["n"].cumsum() // TOKENS)) + 1):
                sets = [shingles(text, k).view(np.int64) for text in batch["text"].iloc[run]]
                out = held.iloc[np.repeat(run, [len(s) for s in sets])].reset_index(drop=True)
                out["token"] = np.concatenate(sets)
                yield out

    rows = texts.select("rep", "g", "n", "bits", "text")
    return rows.mapInPandas(run, "rep long, g long, n long, bits long, token long")


def several_groups(members: DataFrame, valid: str = "true") -> DataFrame:
    """``(key, size)`` of the keys whose members ``(key, rep, g, ...)`` are of more than one group."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("g").alias("_g"), F.max("g").alias("_h"), F.expr(valid).alias("_v"))
    return sizes.where("_g <> _h AND _v").select(own_shuffle(F.col("key")).alias("key"), "size")


def rare_candidates(
    left_over: DataFrame, groups: DataFrame, texts: DataFrame, k: int, at_least: Threshold, leaf: int = LEAF,
    rest: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``(a, b, apart)`` of different groups among the left-over documents, by their rare shingles, with those of
    ``rest``, and the members ``(key, rep, n, bits)`` of the posting lists that are too large to be compared as they are."""
    own = groups.select(F.col("id").alias("_id"), F.col("component").alias("_g"))
    members = left_over.join(own, F.col("rep") == F.col("_id"), "left").select("key", "rep", "n", "bits", F.coalesce("_g", "rep").alias("g"))
    mixed = members.join(several_groups(members), "key").select("rep", "g", "n", "bits").distinct()
    docs = stored(mixed.join(texts, "rep"), "left-over-texts")

    # Only shingles that two groups share can be common to a pair that matters.
    tokens = _tokens(docs, k).withColumnRenamed("token", "key")
    shared = tokens.join(several_groups(tokens), "key")
    from_end = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("size"), F.desc("key")))
    ranked = shared.select("rep", "g", "n", "bits", F.col("key").alias("token"), from_end.alias("r"))
    ranked = ranked.where(F.col("r") >= at_least.common("n", "0"))

    def size_class(n: str) -> str:
        return f"cast(floor(ln({n}) / ln({CLASS}D)) AS int)"

    sizes = f"sequence({size_class(f'n * {at_least.num / at_least.den}D')} - 1, {size_class(f'n * {at_least.den / at_least.num}D')} + 1)"
    met = ranked.select("*", F.expr(size_class("n")).alias("c"), F.explode(F.expr(sizes)).alias("d"))
    met = met.withColumn("least", F.expr(f"greatest(cast(floor(pow({CLASS}D, d)) AS long) - 1, 0L)"))
    met = met.where(F.col("r") >= at_least.common("n", "least"))
    lists = stored(met.select(
        F.xxhash64("token", F.least("c", "d"), F.greatest("c", "d")).alias("key"), "rep", "g", "n", "bits",
        F.expr("CASE WHEN c = d THEN 2 WHEN c < d THEN 0 ELSE 1 END").alias("side"),
    ), "rare-shingles")
    lists = stored(lists.join(several_groups(lists, "max(side) = 2 OR min(side) <> max(side)"), "key"), "rare-lists")
    small, large = lists.where(F.col("size") <= leaf), lists.where(F.col("size") > leaf)
    sides = "(x.side = 0 AND y.side = 1 OR x.side = 2 AND y.side = 2 AND x.rep < y.rep)"
    pairs = _pairs(small, small, F.expr(f"x.key = y.key AND x.g <> y.g AND {sides}"), at_least)
    pairs = pairs if rest is None else pairs.unionByName(rest)
    return stored(pairs.distinct(), "rare-pairs"), large.select("key", "rep", "n", "bits")


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``, by products of 0/1 matrices of at most about
    ``CELLS`` cells (or one row, for a longer set)."""
    words = np.unique(np.concatenate(x))

    def rows(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(words)), np.float32)
        for row, members in zip(out, sets, strict=True):
            at = np.searchsorted(words, members)
            at[at == len(words)] = 0
            row[at[words[at] == members]] = 1
        return out

    step = max(1, CELLS // len(words))
    left = rows(x)
    return np.concatenate([left @ rows(y[i : i + step]).T for i in range(0, len(y), step)], axis=1).astype(np.int64)


def _tiles(members: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """``members`` in runs whose 0/1 matrix has at most about ``CELLS`` cells."""
    start, held = 0, 0
    for i, n in enumerate(size[members]):
        held += n
        if i > start and (i + 1 - start) * held > CELLS:
            yield members[start:i]
            start, held = i, n
    if len(members):
        yield members[start:]


def _block_links(rows: pd.DataFrame, k: int, at_least: Threshold) -> list[tuple[int, int]]:
    """Links between the groups of a pair of blocks, as a spanning forest: rows ``(rep, g, i, j, block, text)``."""
    rows = rows.sort_values(["block", "rep"], ignore_index=True)
    sets = [shingles(t, k) for t in rows["text"]]
    size, block = np.array([len(s) for s in sets]), rows["block"].to_numpy()
    own, other = np.flatnonzero(block == rows["i"][0]), np.flatnonzero(block == rows["j"][0])
    root = {g: g for g in rows["g"]}

    def find(g):
        while root[g] != g:
            root[g] = g = root[root[g]]
        return g

    out = []
    for left in _tiles(own, size):
        for right in _tiles(other, size):
            both = _overlaps([sets[i] for i in left], [sets[j] for j in right])
            union = size[left][:, None] + size[right][None, :] - both
            for i, j in zip(*np.nonzero(at_least.den * both >= at_least.num * union), strict=True):
                a, b = rows["rep"][left[i]], rows["rep"][right[j]]
                ga, gb = find(rows["g"][left[i]]), find(rows["g"][right[j]])
                if ga != gb:
                    root[ga] = gb
                    out.append((min(a, b), max(a, b)))
    return out


def left_over_links(left_over: DataFrame, groups: DataFrame, texts: DataFrame, k: int, at_least: Threshold) -> DataFrame:
    """Links between different groups among documents of posting lists that are large.

    Lists that share documents form a family. Its documents outside its main group are compared on the full sets with all
    others, block by block: a task gets two blocks of about ``FAMILY_BLOCK`` documents and returns a spanning forest at most."""
    leaders = left_over.groupBy("key").agg(F.min("rep").alias("a"))
    edges = left_over.join(leaders, "key").select("a", F.col("rep").alias("b")).where("a <> b").distinct()
    families = components(stored(edges, "edges"))
    own = groups.select(F.col("id").alias("_id"), F.col("component").alias("_g"))
    members = families.select(F.col("id").alias("rep"), F.col("component").alias("family")).join(own, F.col("rep") == F.col("_id"), "left")
    members = stored(members.select("family", "rep", F.coalesce("_g", "rep").alias("g")), "families")
    sizes = members.groupBy("family", "g").agg(F.count("*").alias("n_g"))
    sizes = sizes.groupBy("family").agg(F.max(F.struct("n_g", "g")).alias("main"), F.sum("n_g").alias("n"))
    sizes = sizes.where("n > main.n_g")
    placed = members.join(sizes, "family").select(
        "family", "rep", "g", (F.col("g") != F.col("main.g")).alias("out"),
        F.ceil((F.col("n") - F.col("main.n_g")) / FAMILY_BLOCK).alias("n_out"), F.ceil(F.col("main.n_g") / FAMILY_BLOCK).alias("n_main"),
    )
    at = F.when(F.col("out"), F.pmod(F.xxhash64("rep"), "n_out")).otherwise(F.col("n_out") + F.pmod(F.xxhash64("rep"), "n_main"))
    last = F.when(F.col("out"), F.col("n_out") + F.col("n_main")).otherwise(F.col("n_out")) - 1
    spread = (
        placed.select("family", "rep", "g", at.alias("block"), last.alias("last"))
        .join(texts, "rep")
        .select("family", "rep", "g", "block", "text", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("t"))
        .select("family", "rep", "g", "block", "text", F.least("block", "t").alias("i"), F.greatest("block", "t").alias("j"))
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_block_links(rows, k, at_least), columns=["a", "b"], dtype="int64")

    return spread.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def near_groups(
    df: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH, leaf: int = LEAF,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    at_least = Threshold(num, den)
    trees, levels = at_least.forest(depth)
    sketch = stored(sketches(df, k, id_col, text_col, max(BITS, trees * levels)), "sketches")
    usable = sketch.where("doc_id IS NOT NULL AND n > 0")
    shared = usable.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
    if shared.limit(1).count():
        return _renumbered_groups(df, k, num, den, id_col, text_col, depth, leaf)
    least = F.min(F.struct(F.col("doc_id").alias("rep"), "n", "bits", "sig")).alias("least")
    reps = stored(usable.groupBy("digest").agg(least).select("least.*", "digest"), "class-reps")
    classes = reps.select(F.col("digest").alias("_digest"), "rep")

    pairs, left_over = candidates(reps, at_least, depth, leaf)
    # The texts of documents in any candidate pair are gathered once, one row per id.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(left_over.select("rep")).distinct()
    texts = df.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).where("rep IS NOT NULL")
    # A merge join at every size: the ids grow with the corpus, so broadcasting them is no plan.
    texts = stored(texts.join(wanted.hint("merge"), "rep", "left_semi").dropDuplicates(["rep"]), "candidate-texts")

    links: list[DataFrame] = []
    alone = reps.select(F.col("rep").alias("id"), F.col("rep").alias("component"))
    if not left_over.take(1):
        _, groups = settle(pairs, None, links, texts, k, at_least)
    else:
        # What the first round leaves is confirmed together with the candidates of step 5.
        rest, groups = settle(pairs, None, links, texts, k, at_least, ROUNDS[:1])
        rest, left_over = rare_candidates(left_over, alone if groups is None else groups, texts, k, at_least, leaf, rest)
        _, groups = settle(rest, groups, links, texts, k, at_least)
        if left_over.take(1):
            more = stored(left_over_links(left_over, alone if groups is None else groups, texts, k, at_least), "left-over-links")
            if more.take(1):
                links.append(more)
                groups = stars(union(links))
    if groups is None:
        groups = alone

    named = classes.join(groups, F.col("rep") == F.col("id"), "left").select(
        "_digest", F.coalesce("component", "rep").alias("component_id")
    )
    key = (F.col("digest") == F.col("_digest")) & F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return sketch.join(named, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def _renumbered_groups(df: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, depth: int, leaf: int) -> DataFrame:
    """The groups where different texts share an id: each text is a document of its own, in the order of ids."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(F.col(text_col)).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    order = document_order(rows.where("doc_id IS NOT NULL"))
    named = rows.join(order, F.expr("doc_id = _id AND digest = _digest"), "left").select("at", "text")
    out = near_groups(named, k, num, den, "at", "text", depth, leaf).withColumnsRenamed({"doc_id": "x", "component_id": "y"})
    own, first = (order.select(F.col("at").alias(c), F.col("_id").alias(n)) for c, n in (("x", "doc_id"), ("y", "component_id")))
    return out.join(own, "x", "left").join(first, "y", "left").select("doc_id", "n_shingles", "component_id", "kept")


def deduplicate(df: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``df`` that stay: one document of each group (rows that repeat its id stay with it)."""
    # Texts under one id stay or go together: with the id, if any of them stays.
    verdict = near_groups(df, k, num, den).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = stored(verdict.where("NOT kept").select("doc_id"), "near-gone")
    rows = df.select(packed(df), F.col("doc_id").cast("long").alias("id"))
    return rows.join(gone, F.expr("id = doc_id"), "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), k=3, num=85)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS shingle
  FROM w, LATERAL (SELECT unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle)
  WHERE x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
