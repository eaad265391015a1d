"""Centroid clustering of integer vectors with a threshold algorithm for the nearest centroid.

Every component x becomes floor(SCALE * x), so distances, sums and means are exact integers and a result does not depend on how rows are
dealt to tasks. The start is the k vectors with the least seeded hash of their ids; each round assigns all vectors
and replaces every non-empty centroid by its vectors' floored mean.

Nearest centroid. Per dimension the centroids' values are a sorted list. Two frontiers leave the vector's own value, downwards and
upwards, and at each step every dimension's list is walked one entry further, to the nearer side. A centroid met for the
first time gets its exact distance. A centroid not met yet lies beyond the frontier in every dimension, so the sum of the squared
frontier distances bounds its distance from below; once that sum strictly exceeds the best exact distance (a tie could
still go to a smaller number), or no centroid is left unmet, the vector is settled. A batch of vectors walks together
in NumPy, without those that are settled.

Spark reads the stored integer vectors once per round; a task adds up its own vectors per cluster, so at most k rows a task are
shuffled whatever the cluster sizes, and k centroids (the one thing broadcast or collected) come to the driver.

Defined cases: vectors with another number of components, or with a NULL or non-finite one, are left out, as is a NULL vector. Rows that
repeat an id are vectors each; equal ids tie by their components at the start. A NULL id counts as the empty string in the hash.
With fewer than k vectors there are as many centroids; an empty table gives an empty result. Integers beyond +-2**26 raise, as
distances might not fit a long. Only the id and vector columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored, table

K, DIMENSIONS, SCALE, ROUNDS, SEED = 40, 64, 256, 5, 2
#: Largest integer component: squared distances of thousands of dimensions fit 63 bits.
LARGEST = 1 << 26
#: Vectors that walk the lists together.
BATCH = 2048


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` of the usable vectors, ``v`` an array of integers."""
    x = F.col("x")
    usable = (F.size(x) == dimensions) & F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    scaled = lambda c: F.floor(c * F.lit(float(scale)))
    checked = lambda c: F.when(F.abs(c * F.lit(float(scale))) <= LARGEST, scaled(c)).otherwise(
        F.raise_error(F.lit(f"a component is beyond {LARGEST} in units of 1/{scale}")).cast("long")
    )
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return rows.where(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform(x, lambda c: checked(c).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the least hashes, in the order of hashes (a top-k of each task, merged)."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(rank.alias("rank"), "v").orderBy("rank", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


class SortedLists:
    """The centroids' values sorted per dimension, for walks outward from a vector."""

    def __init__(self, centroids: np.ndarray):
        self.k, self.dimensions = centroids.shape
        # Exact in floats while squared distances stay below 2**53, in integers else.
        wide = 4 * self.dimensions * int(max(1, np.abs(centroids).max(initial=0))) ** 2
        self.number = np.float64 if wide < 1 << 40 else np.int64
        self.centroids = centroids.astype(self.number)
        order = np.argsort(centroids, axis=0, kind="stable").T
        values = np.take_along_axis(centroids.T, order, axis=1)
        # Ends of the lists: farther away than any value can be, and never the nearer side while another entry is left.
        self.values = np.pad(values, ((0, 0), (1, 1)), constant_values=((0, 0), (-8 * LARGEST, 8 * LARGEST))).astype(np.int32)
        self.names = np.pad(order, ((0, 0), (1, 1))).astype(np.int64)
        self.row = np.arange(self.dimensions) * (self.k + 2)

    def _distances(self, vectors: np.ndarray, centroid: int) -> np.ndarray:
        apart = vectors - self.centroids[centroid]
        return np.einsum("ij,ij->i", apart, apart).astype(np.int64)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each row, its squared distance, and how many exact distances that took."""
        n = len(vectors)
        best, distance = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        if np.abs(vectors).max(initial=0) > 1 << 18:
            self.number, self.centroids = np.int64, self.centroids.astype(np.int64)
        wide = vectors.astype(self.number)
        low = np.empty((n, self.dimensions), np.int64)  # the next entry below or at the value, and the next above
        for d in range(self.dimensions):
            low[:, d] = np.searchsorted(self.values[d, 1:-1], vectors[:, d], side="right")
        low += self.row
        high = low + 1
        values, names = self.values.ravel(), self.names.ravel()
        alive, met, taken = np.arange(n), np.zeros((n, self.k), bool), 0
        own = vectors.astype(np.int32)
        for _ in range(self.k):
            below, above = own - values[low], values[high] - own
            down = below <= above
            entry = np.where(down, low, high)
            new = np.zeros((len(alive), self.k), bool)
            new[np.arange(len(alive))[:, None], names[entry]] = True
            new &= ~met
            met |= new
            for c in np.flatnonzero(new.any(axis=0)):
                rows = np.flatnonzero(new[:, c])
                at = alive[rows]
                apart = self._distances(wide[at], c)
                taken += len(at)
                # Numbers may be met in any order: of equal distances the smaller one stays.
                better = (apart < distance[at]) | ((apart == distance[at]) & (c < best[at]))
                best[at[better]], distance[at[better]] = c, apart[better]
            low, high = low - down, high + ~down
            frontier = np.minimum(below, above).astype(np.int64)
            beyond = np.einsum("ij,ij->i", frontier, frontier)
            open_ = (beyond <= distance[alive]) & ~met.all(axis=1)
            if not open_.any():
                break
            alive, met, own, low, high = alive[open_], met[open_], own[open_], low[open_], high[open_]
        return best, distance, taken


def _batches(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids and vectors of a record batch, ``BATCH`` at a time."""
    for at in range(0, batch.num_rows, BATCH):
        part = batch.slice(at, BATCH)
        yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of each non-empty cluster; a task sends one row per cluster."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for _, part in _batches(batch, dimensions):
                best, _, _ = lists.nearest(part)
                order = np.argsort(best, kind="stable")
                names, heads = np.unique(best[order], return_index=True)
                sums[names] += np.add.reduceat(part[order].astype(np.int64), heads, axis=0)
                counts += np.bincount(best, minlength=k)
        used = np.flatnonzero(counts)
        columns = [pa.array(used), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("vec_id", "v").mapInArrow(run, "cluster long, n long, sums array<long>")
    exact = [F.sum(F.get("sums", F.lit(d)).cast("decimal(20,0)")).alias(f"s{d}") for d in range(dimensions)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()  # at most k rows
    return {r["cluster"]: (r["n"], [int(r[f"s{d}"]) for d in range(dimensions)]) for r in rows}


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Every non-empty centroid replaced by the floored mean of its vectors."""
    out = centroids.copy()
    for cluster, (n, total) in sums.items():
        out[cluster] = [s // n for s in total]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            for ids, part in _batches(batch, dimensions):
                best, distance, _ = lists.nearest(part)
                yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
    progress: Callable[[int, np.ndarray], None] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """The assignment ``(vec_id, cluster, distance)`` of all usable vectors, and the final centroids.

    ``progress(round, centroids)`` is called with the start and after every round."""
    vectors = stored(integer_vectors(df, id_col, vector_col, dimensions, scale), "integer-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for step in range(rounds):
        if progress:
            progress(step, centroids)
        centroids = moved(centroids, cluster_sums(vectors, centroids))
    if progress:
        progress(rounds, centroids)
    return assign(vectors, centroids), centroids


def summary(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per non-empty cluster: ``_cluster, cluster_inertia, inertia, centroid_sha256`` (at most k rows)."""
    spark = assigned.sparkSession
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in sums)
    rows = [(r["cluster"], r["d"], total, digest[r["cluster"]]) for r in sums]
    return spark.createDataFrame(rows, "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    assigned = stored(assigned, "assigned")
    of = F.broadcast(summary(assigned, centroids))  # a row per centroid
    return assigned.join(of, F.col("cluster") == F.col("_cluster")).drop("_cluster")


def _oracle() -> str:
    """The rounds written out one after another, distances over whole lists."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT {K}))"""
    ]
    apart = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, best.c AS c, best.d AS distance FROM (
    SELECT k.vec_id, any_value(k.v) AS v, min({{'d': CAST({apart} AS BIGINT), 'c': c.c}}) AS best
    FROM kept k, c{r} c GROUP BY k.vec_id))""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range({DIMENSIONS})) AS i FROM a{r}) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(n.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m{r} GROUP BY c) n ON n.c = c{r}.c)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.c = c.c
"""


ORACLE = _oracle()
