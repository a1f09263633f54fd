"""Centroid clustering against plain rounds over all distances."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerwatch.llm import centroids

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, config):
    kept = []
    for i, v in rows:
        if v is None or len(v) != config.dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(config.scale * float(np.float32(x))) for x in v]))
    first = sorted((hashlib.sha256(f"{config.seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[: config.k]
    middle = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(config.rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(middle)):
            members = [v for (_, v), c in zip(kept, own, strict=True) if c == n]
            if members:
                middle[n] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    final = [(i, *nearest(v)) for i, v in kept] if middle else []
    total = sum(d for _, d, _ in final)
    return sorted(
        (
            (i, c, d, sum(e for _, e, b in final if b == c), total, hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest())
            for i, d, c in final
        ),
        key=str,
    )


def got(frame):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect()), key=str)


def many():
    random.seed(5)
    rows = [(i, [random.gauss(i % 5, 0.4) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # one very common vector
    rows += [(2000 + i, [float(i % 2)] * 6) for i in range(40)]  # ties
    rows += [(3000, None), (3001, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (3002, [float("nan")] * 6), (3003, [float("-inf")] * 6), (3004, []), (3005, [1.0] * 7)]
    return rows + [(5, [0.25] * 6), (5, [0.25] * 6), (None, [0.5] * 6), (3006, [-0.0] * 6)]


@pytest.mark.parametrize("k", [1, 3, 8])
def test_rounds_match_plain_ones(spark, k):
    config = centroids.ClusterConfig(k=k, dims=6)
    frame = spark.createDataFrame([(i, v, 0) for i, v in many()], VECTORS).repartition(3)
    assert got(centroids.cluster(frame, config)) == plain(many(), config)


def test_threshold_walk_is_exact_and_stops_early():
    rng = np.random.default_rng(1)
    for dims, k, spread in ((1, 5, 3), (2, 8, 4), (8, 40, 50), (64, 8, 1000), (3, 6, 2)):
        middle = rng.integers(-spread, spread + 1, (k, dims))
        middle[-1] = middle[0]  # equal centroids: the smaller number wins
        vectors = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (500, dims)), middle])
        all_ = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2)
        cluster, distance = centroids.SortedLists(middle).nearest(vectors)
        assert (cluster == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()

    class Counting(np.ndarray):
        read = 0

        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and key.ndim == 1 and self.ndim == 2:
                Counting.read += len(key)
            return np.asarray(out)

    lists = centroids.SortedLists(np.repeat(np.arange(100)[:, None] * 1000, 2, axis=1))
    lists.centroids = lists.centroids.view(Counting)
    lists.nearest(np.array([[50_010, 49_990]] * 10))
    assert 0 < Counting.read < 10 * 10  # not all of 100 centroids


def test_large_components_and_few_vectors(spark):
    rows = [(1, [3e38, -3e38, 0.0], 0), (2, [-3e38, 3e38, 1.0], 0)]
    frame = spark.createDataFrame(rows, VECTORS)
    out = centroids.cluster(frame, centroids.ClusterConfig(k=8, dims=3)).collect()
    assert sorted(r.vec_id for r in out) == [1, 2] and {r.distance for r in out} == {0} and len({r.cluster for r in out}) == 2
    one = centroids.cluster(frame, centroids.ClusterConfig(k=1, dims=3)).collect()
    assert all(r.distance > 0 and r.inertia == sum(x.distance for x in one) for r in one)


def test_no_vectors_clashing_columns_and_no_ids(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.75, 0.5], 0)], VECTORS)
    config = centroids.ClusterConfig(k=2, dims=2)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    clashing = frame.withColumns({"cluster": F.lit("mine"), "v": F.lit("mine"), "distance": F.lit("mine"), "own": F.lit(1)})
    assert centroids.cluster(clashing, config).columns == columns
    assert got(centroids.cluster(clashing, config)) == got(centroids.cluster(frame, config))
    for empty in (frame.limit(0), frame.withColumn("vec_id", F.lit(None).cast("long"))):
        assert centroids.cluster(empty, config).count() == 0 and centroids.cluster(empty, config).columns == columns
