"""Centroid clustering with exact nearest centroids by the threshold algorithm.

For every dimension the centroids are sorted by their coordinate. A vector enters
each of these lists where its own coordinate belongs and walks outward, always to the
nearer of the next centroid below and the next above. A centroid met in any list gets
its exact squared distance once. What a list has not yet shown lies at least as far
out as its frontier, so the sum of squared frontier gaps over all dimensions bounds
every unseen centroid from below. A vector stops when that sum strictly exceeds its
best exact distance: an unseen centroid at the same distance may have a smaller number.
All vectors of a slice walk together, a step of every list at a time.

Vectors become whole numbers once and are stored. A round is one pass over that table
that ends in sums and counts per centroid and dimension, added within each task before
they are shuffled; only the new centroids (``k`` rows) come to the driver.

Defined results: vectors of another length, null, or with null or non-finite
components take no part. Components are kept within 2**27 on either side once scaled,
so distances fit 64 bits. Rows that repeat an id are vectors of their own. Rows without
an id are clustered but start no centroid. With fewer than ``k`` rows that may start
one there are as many centroids as those. No vectors, or no ids, give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored

EDGE = 1 << 27
_SLICE = 4096


@dataclass(frozen=True)
class ClusterConfig:
    k: int = 8
    rounds: int = 10
    dims: int = 64
    scale: float = 1024.0
    seed: int = 3


def scaled(vectors: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """vec_id and whole numbers ``v`` of the vectors that take part."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def whole(x: Column) -> Column:
        return F.floor(F.least(F.greatest(F.lit(config.scale) * x.cast("double"), F.lit(-float(EDGE))), F.lit(float(EDGE)))).cast("int")

    kept = vectors.where((F.size("embedding") == config.dims) & F.forall("embedding", usable))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def first_centroids(rows: DataFrame, config: ClusterConfig = ClusterConfig()) -> np.ndarray:
    """The vectors of the k smallest hashes of ``seed:vec_id``, in the order of their hashes."""
    key = F.sha2(F.concat(F.lit(f"{config.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id IS NOT NULL").select(key.alias("key"), "v").orderBy("key", "v").limit(config.k).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), config.dims)


class SortedLists:
    """Centroids sorted by coordinate, one list per dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")  # [place, dimension] -> centroid
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smallest of equals) and its squared distance, for each vector."""
        n, dims = vectors.shape
        k = len(self.centroids)
        best = np.full(n, np.iinfo(np.int64).max)
        cluster = np.full(n, k)
        open_ = np.arange(n)
        above = np.empty((n, dims), np.int64)  # next place upward; the one below is above - 1 - steps
        for d in range(dims):
            above[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        below = above - 1
        seen = np.zeros((n, k), bool)
        column = np.arange(dims)
        far = np.int64(4 * EDGE)
        for _ in range(k):
            x, up, down = vectors[open_], above[open_], below[open_]
            up_gap = np.where(up < k, self.values[np.minimum(up, k - 1), column] - x, far)
            down_gap = np.where(down >= 0, x - self.values[np.maximum(down, 0), column], far)
            rise = up_gap < down_gap
            met = self.order[np.where(rise, np.minimum(up, k - 1), np.maximum(down, 0)), column]
            fresh = np.zeros((len(open_), k), bool)
            fresh[np.arange(len(open_))[:, None], met] = True
            fresh &= ~seen[open_]
            seen[open_] |= fresh
            row, centroid = np.nonzero(fresh)
            gaps = x[row] - self.centroids[centroid]
            distance = np.einsum("ij,ij->i", gaps, gaps)
            # Smallest distance, then smallest number, of each row's new centroids.
            ranked = np.lexsort((centroid, distance, row))
            row, centroid, distance = row[ranked], centroid[ranked], distance[ranked]
            lead = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
            row, centroid, distance = open_[row[lead]], centroid[lead], distance[lead]
            better = (distance < best[row]) | ((distance == best[row]) & (centroid < cluster[row]))
            best[row[better]], cluster[row[better]] = distance[better], centroid[better]
            # Each list moves on; its frontier is what it showed last, and everything unseen lies beyond.
            above[open_], below[open_] = up + rise, down - ~rise
            frontier = np.minimum(up_gap, down_gap)
            bound = np.einsum("ij,ij->i", frontier, frontier)
            open_ = open_[(bound <= best[open_]) & ~seen[open_].all(axis=1)]
            if not len(open_):
                break
        return cluster, best


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def sums(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, dim, total and n of the vectors assigned to each centroid."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _matrix(batch, dims)
            for a in range(0, len(vectors), _SLICE):
                some = vectors[a : a + _SLICE]
                cluster, _ = lists.nearest(some)
                order = np.argsort(cluster, kind="stable")
                own, first = np.unique(cluster[order], return_index=True)
                total[own] += np.add.reduceat(some[order], first, axis=0)
                count += np.bincount(cluster, minlength=k)
        if count.any():
            columns = [np.repeat(np.arange(k, dtype=np.int32), dims), np.tile(np.arange(dims, dtype=np.int32), k), total.ravel(), np.repeat(count, dims)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "total", "n"])

    parts = rows.select("v").mapInArrow(run, "cluster int, dim int, total long, n long")
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def fit(rows: DataFrame, config: ClusterConfig = ClusterConfig()) -> np.ndarray:
    """Centroids after all rounds; one without vectors stays where it is."""
    centroids = first_centroids(rows, config)
    for _ in range(config.rounds if len(centroids) else 0):
        after = centroids.copy()
        for r in sums(rows, centroids).where("n > 0").collect():  # k * dims rows
            after[r.cluster, r.dim] = int(r.total) // r.n
        if (after == centroids).all():
            break  # every further round would change nothing
        centroids = after
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every row."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            vectors = _matrix(batch, dims)
            for a in range(0, len(vectors), _SLICE):
                cluster, distance = lists.nearest(vectors[a : a + _SLICE])
                columns = [batch.column("vec_id").slice(a, len(cluster)), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    Inertias are exact sums, cut at the largest 64-bit number.
    """
    spark = vectors.sparkSession
    rows = stored(scaled(vectors, config), "cluster-vectors")
    centroids = fit(rows, config)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    assigned = stored(assign(rows, centroids), "cluster-assigned")
    # One row per centroid, so at most k.
    inertias = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    table = pa.table(
        {
            "own": pa.array(range(len(centroids)), pa.int32()),
            "cluster_inertia": pa.array([min(inertias.get(c, 0), most) for c in range(len(centroids))], pa.int64()),
            "inertia": pa.array([min(sum(inertias.values()), most)] * len(centroids), pa.int64()),
            "centroid_sha256": [centroid_sha256(c) for c in centroids],
        }
    )
    about = spark.createDataFrame(table)
    return assigned.join(F.broadcast(about), F.col("cluster") == F.col("own")).drop("own")
