import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import pivot_clusters


def _clustered(rows, clusters, rounds, size, scale=256, seed=2):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in starts[:clusters]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, group in groups.items():
            centroids[n] = [sum(x) // len(group) for x in zip(*group)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in found)
    own = {n: sum(d for _, d, m in found if m == n) for n in range(len(centroids))}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, own[n], inertia, marks[n]) for i, d, n in found), key=str)


@pytest.mark.parametrize("clusters, pivots, sample", [(6, 5, 50), (40, 24, 2048), (1, 1, 1), (3, 24, 2)])
def test_clustered_as_by_all_distances(spark, clusters, pivots, sample):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(rng.choice((-2, 0, 3)), 0.4) for _ in range(5)]) for i in range(300)]
    rows += [(400 + i, [1.0] * 5) for i in range(50)] + [rows[3], rows[3], (5, [0.0] * 5)]
    rows += [(500, None), (501, []), (502, [1.0] * 4), (503, [None] + [1.0] * 4), (504, [float("nan")] * 5), (505, [float("-inf")] * 5), (None, [2.0] * 5), (506, [3e4] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({x: F.lit("clash") for x in ("id", "vector", "cluster", "body", "table", "distance")}).repartition(3)
    found = pivot_clusters.cluster(frame, clusters, 3, 5, pivots=pivots, sample=max(sample, clusters))
    assert sorted(map(tuple, found.collect()), key=str) == _clustered(rows, clusters, 3, 5)


def test_no_vectors_and_too_large_ones(spark):
    frame = spark.createDataFrame([(1, [1.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert pivot_clusters.cluster(frame, size=2).collect() == []
    assert pivot_clusters.cluster(frame.limit(0), size=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="64 bits"):
        pivot_clusters.cluster(spark.createDataFrame([(1, [1e300, 1.0])], "vec_id long, embedding array<double>"), size=2)


def test_bounds_leave_out_far_centroids_and_never_a_nearest():
    rng = np.random.default_rng(3)
    for spread in (1, 1000, 1 << 26):
        middles = rng.integers(-spread, spread, (30, 8))
        vectors = middles[rng.integers(0, 30, 3000)] + rng.integers(-max(1, spread // 50), max(2, spread // 50), (3000, 8))
        centroids = np.concatenate([middles, middles[:3]])  # three ties
        pivots = pivot_clusters.spread_pivots(vectors[:200], 12)
        table = np.sqrt(pivot_clusters.distances(vectors, pivots).astype(np.float64))
        where, best, taken = pivot_clusters.nearest(vectors, table, centroids, pivots)
        every = pivot_clusters.distances(vectors, centroids)
        assert (where == every.argmin(1)).all() and (best == every.min(1)).all()
        if spread > 1:
            assert taken < 0.3 * every.size
