from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from compare import assert_same, oracle_frame
from tripmill.llm.centroids import Rotation, cluster_vectors, nearest
from tripmill.llm.queries import ORACLES, op12_centroid_clusters


def brute(rows, k, dims, rounds=10, scale=1024):
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    ordered = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(p) for _, p in ordered[:k]]

    def assign(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, p in kept:
            groups.setdefault(assign(p)[1], []).append(p)
        for j, members in groups.items():
            centroids[j] = [sum(column) // len(members) for column in zip(*members)]
    placed = [(i, *assign(p)) for i, p in kept]
    total = sum(d for _, d, _ in placed)
    return sorted(
        (
            -1 if i is None else i,
            j,
            d,
            sum(e for _, e, l in placed if l == j),
            total,
            hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest(),
        )
        for i, d, j in placed
    )


def got(df, **options):
    return sorted((-1 if row[0] is None else row[0], *row[1:]) for row in cluster_vectors(df, **options).collect())


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, cluster int, id int, point string, distance long"
    return spark.createDataFrame([(i, v, 1, 2, "p", 3) for i, v in rows], schema).repartition(5)


def test_same_as_brute_force(spark):
    random = np.random.default_rng(4)
    centres = random.normal(size=(6, 8)) * 3
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + random.normal(size=8)]) for i in range(400)]
    assert got(frame(spark, rows), k=5, dims=8, leading=3) == brute(rows, 5, 8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [1.0, 2.0]), (None, [1.0, 2.0])]
    rows += [(3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0])]
    rows += [(10, [0.0, 0.0]), (11, [0.0, 0.0]), (12, [-0.00001, 1000.0])]
    for k in (1, 3, 8, 50):
        assert got(frame(spark, rows), k=k, dims=2, leading=1) == brute(rows, k, 2)
    assert got(frame(spark, []), k=3, dims=2, leading=1) == []
    assert got(frame(spark, rows[5:9]), k=3, dims=2, leading=1) == []


def test_equal_vectors_hold_most_rows(spark):
    rows = [(i, [1.5, 2.5, 3.5]) if i % 3 else (i, [float(i), 0.0, -float(i)]) for i in range(300)]
    assert got(frame(spark, rows), k=4, dims=3, leading=2) == brute(rows, 4, 3)


def test_too_large_components_are_refused(spark):
    with pytest.raises(PySparkException, match="would not fit"):
        cluster_vectors(frame(spark, [(1, [1e30, 0.0])]), k=1, dims=2, leading=1)


def test_the_filter_spares_distances_and_keeps_the_nearest():
    random = np.random.default_rng(1)
    basis = np.linalg.qr(random.normal(size=(32, 32)))[0]
    wide = np.concatenate([np.full(4, 2000.0), np.full(28, 20.0)])
    points = np.floor((random.normal(size=(2000, 32)) * wide) @ basis.T).astype(np.int64)
    centroids = points[:40]
    mean = points.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((points - mean).T))
    rotation = Rotation(mean, axes[:, ::-1][:, :4])
    cluster, distance, measured = nearest(points, *rotation.apply(points), centroids, rotation)
    exact = ((points[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < 0.1 * exact.size


def test_same_as_the_oracle(spark, small):
    assert_same(op12_centroid_clusters(spark, small), oracle_frame(small, ORACLES["op12_centroid_clusters"]))
