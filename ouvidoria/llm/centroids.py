"""Centroid clustering (Lloyd rounds) with the equal-average equal-variance nearest-neighbour search.

Centroids are sorted by the mean of their components. A vector starts at the place of its own mean and scans outward, the
nearer mean first. Two inequalities spare it exact distances: the squared difference of the means, times the number of
components, is a lower bound that only grows outward, so once it exceeds the best distance the scan ends; with the squared
difference of the deviations from the mean added, it rejects single centroids. What is left is finished in whole numbers.

Vectors are scaled to whole numbers once and staged. A round is one scan of that table: a task keeps one sum per centroid
and component, so what is shuffled, collected and broadcast has centroids x components rows, whatever the table holds.

Defined results: vectors that are null, of another size, or hold null or non-finite components take no part, nor do those
whose scaled components exceed ``LARGEST`` in size (no whole number of 64 bits holds such distances); distances and
inertias beyond 64 bits stop at the largest such number. Ties go to the smaller centroid. Rows without an id are clustered
but never start a centroid; rows that repeat an id count and are returned each, and of equal ids the smaller vector starts
first. Fewer vectors than centroids make fewer centroids; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import staged

DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
# Components in size: sums of them over any table fit a decimal of 38 digits.
LARGEST = 2.0**80
# Up to this size 64-bit arithmetic is exact in all that is compared; beyond it Python's whole numbers are used.
_NARROW = 2**24
_MOST = 2**63 - 1


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every vector that takes part, as doubles without fraction."""

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            right = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
            batch = batch.filter(right)
            flat = pc.cast(pc.list_flatten(batch.column("embedding")), pa.float64(), safe=False)
            with np.errstate(over="ignore", invalid="ignore"):
                v = np.floor(flat.to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
                fits = (np.abs(v) <= LARGEST).all(axis=1)  # false for what is not a number
            yield pa.record_batch([batch.column("vec_id").filter(pa.array(fits)), _lists(v[fits])], names=["vec_id", "v"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, v array<double>")


def _lists(v: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]
    return pa.ListArray.from_arrays(offsets, v.ravel())


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return pc.list_flatten(batch.column("v")).to_numpy(zero_copy_only=False).reshape(-1, dims)


class EqualAverageSearch:
    """Nearest of a few centroids (rows of whole numbers) for many vectors at once."""

    def __init__(self, centroids: list[list[int]]):
        self.dims = len(centroids[0])
        self.number = np.array(sorted(range(len(centroids)), key=lambda i: (sum(centroids[i]), i)))
        self.centroids = [centroids[i] for i in self.number]
        self.narrow = max(abs(x) for c in centroids for x in c) < _NARROW
        self.tables: dict[type, tuple] = {}
        self.exact = 0  # distances computed so far

    def _table(self, kind: type):
        """Centroids in order of their sums, the sums, and how far each deviates from its mean."""
        if kind not in self.tables:
            c = np.array(self.centroids, dtype=kind)
            self.tables[kind] = (c, c.sum(axis=1), self._deviation(c))
        return self.tables[kind]

    def _deviation(self, v: np.ndarray) -> np.ndarray:
        """Length of the vector without its mean; zero, which rejects nothing, where doubles could not hold it."""
        if v.dtype == object:
            return np.zeros(len(v))
        squares, sums = (v * v).sum(axis=1), v.sum(axis=1).astype(float)
        return np.sqrt(np.maximum(0.0, squares - sums * sums / self.dims))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector."""
        if self.narrow and (not vectors.size or np.abs(vectors).max() < _NARROW):
            x = vectors.astype(np.int64)
        else:
            x = np.array([[int(a) for a in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)
        c, means, deviations = self._table(x.dtype.type if x.dtype != object else object)
        n, last = len(x), len(c) - 1
        own, deviation = x.sum(axis=1), self._deviation(x)
        best, owner = np.zeros(n, x.dtype), np.full(n, -1)
        right = np.searchsorted(means, own) if n else np.zeros(0, np.int64)
        left = right - 1
        active = np.arange(n)
        while len(active):
            l, r = left[active], right[active]
            below, above = own[active] - means[np.maximum(l, 0)], means[np.minimum(r, last)] - own[active]
            down = (l >= 0) & ((r > last) | (below <= above))
            at, gap = np.where(down, l, r), np.where(down, below, above)
            # Equal averages: farther out the means only differ more.
            open_ = ((owner[active] < 0) | (gap * gap <= self.dims * best[active])).astype(bool)
            active, at, gap, down = active[open_], at[open_], gap[open_], down[open_]
            # Equal variances: with a margin for what doubles round off.
            bound = (gap * gap).astype(float) / self.dims + (deviation[active] - deviations[at]) ** 2
            near = (owner[active] < 0) | (bound * (1 - 1e-9) - 1 <= best[active].astype(float))
            rows, to = active[near], at[near]
            self.exact += len(rows)
            away = x[rows] - c[to]
            d = (away * away).sum(axis=1)
            number = self.number[to]
            nearer = (owner[rows] < 0) | (d < best[rows]) | ((d == best[rows]) & (number < owner[rows]))
            nearer = nearer.astype(bool)
            best[rows[nearer]], owner[rows[nearer]] = d[nearer], number[nearer]
            left[active] -= down
            right[active] += ~down
            active = active[(left[active] >= 0) | (right[active] <= last)]
        return owner, best


def sums(whole: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of their components, for every centroid that is the nearest of any."""
    dims = len(centroids[0])

    def run(batches):
        search = EqualAverageSearch(centroids)
        counts, totals = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), object)
        for batch in batches:
            v = _vectors(batch, dims)
            owner, _ = search.nearest(v)
            for k in np.unique(owner).tolist():
                mine = v[owner == k]
                counts[k] += len(mine)
                if np.abs(mine).max() < _NARROW:
                    totals[k] += mine.astype(np.int64).sum(axis=0)
                else:
                    totals[k] += np.array([sum(map(int, column)) for column in mine.T.tolist()], dtype=object)
        used = np.flatnonzero(counts)
        yield pa.record_batch(
            [
                pa.array(np.repeat(used, dims), pa.int32()),
                pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
                pa.array(np.repeat(counts[used], dims), pa.int64()),
                pa.array([Decimal(int(t)) for t in totals[used].ravel()], pa.decimal128(38, 0)),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    parts = whole.mapInArrow(run, "cluster int, dim int, n long, total decimal(38,0)")
    found: dict[int, tuple[int, list[int]]] = {}
    # At most centroids x components rows reach the driver.
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        found.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["dim"]] = int(r["total"])
    return found


def first_centroids(whole: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hashes of ``seed:vec_id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.filter(F.col("vec_id").isNotNull()).orderBy(order, "v").limit(k).select("v").collect()
    return [[int(x) for x in r["v"]] for r in rows]


def lloyd(whole: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """Centroids after ``rounds`` rounds; rounds after one that moved nothing would move nothing either."""
    for _ in range(rounds):
        found = sums(whole, centroids)
        moved = [[t // found[i][0] for t in found[i][1]] if i in found else c for i, c in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    return centroids


def assigned(whole: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""

    def run(batches):
        search = EqualAverageSearch(centroids)
        for batch in batches:
            owner, d = search.nearest(_vectors(batch, len(centroids[0])))
            d = pa.array([min(int(x), _MOST) for x in d.tolist()], pa.int64())
            yield pa.record_batch([batch.column("vec_id"), pa.array(owner, pa.int32()), d], names=["vec_id", "cluster", "distance"])

    return whole.mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector (vec_id, embedding) that takes part."""
    whole = staged(whole_vectors(vectors, dims, scale), "whole-vectors")
    centroids = first_centroids(whole, k, seed)
    if not centroids:
        # Vectors without any id start no centroid; there is nothing to assign them to.
        nothing = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], nothing)
    centroids = lloyd(whole, centroids, rounds)
    found = staged(assigned(whole, centroids), "assigned")
    # One row per centroid.
    rows = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in rows}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of([min(inertia.get(i, 0), _MOST) for i in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), _MOST)).cast("long").alias("inertia"),
        of(digest).alias("centroid_sha256"),
    )
