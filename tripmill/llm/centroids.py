"""Centroid clustering (Lloyd's rounds) over integer vectors, with a PCA-rotated filter in front of exact distances.

The covariance of all vectors gives a rotation. Each vector is stored once with its leading rotated coordinates and
the norm of what they leave over. For a vector and a centroid, the squared distance of the leading coordinates plus
the squared difference of the residual norms is never more than their squared distance. The centroid with the smallest
such bound is measured exactly in integers; any other whose bound is not above that distance is measured, too. Bounds
are lowered by more than their rounding error, so the filter never decides, it only spares distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import importable
from tripmill.scratch import new_folder, scratch_folder, stage

# Sums of 64 squares of differences of such components fit a long.
COMPONENT_LIMIT = 1 << 27
# Rounding of a bound is far below this part of the squared norms it was computed from.
_SLACK = 1e-9
# Rows of a batch that are measured at once.
_BLOCK = 4096

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Rotation:
    """The mean, and the leading principal axes as orthonormal columns."""

    mean: np.ndarray
    axes: np.ndarray

    def apply(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the norm of what they leave over (by subtraction, so that it is exact near 0)."""
        centred = points - self.mean
        leading = centred @ self.axes
        return leading, np.linalg.norm(centred - leading @ self.axes.T, axis=1)


def _points(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def integer_points(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id`` and ``point``: ``floor(scale * x)`` of each component x as a double, for whole vectors only."""
    vector = F.col(f"`{vector_col}`")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def component(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x.cast("double"))
        # The comparison is on the double: a larger one would be cut off by the cast.
        message = F.lit(f"a component is beyond {COMPONENT_LIMIT} after scaling: distances would not fit a long")
        fits = F.abs(F.lit(float(scale)) * x.cast("double")) <= float(COMPONENT_LIMIT)
        return F.when(fits, value.cast("int")).otherwise(F.raise_error(message).cast("int"))

    kept = vectors.filter(F.coalesce((F.size(vector) == dims) & whole, F.lit(False)))
    return kept.select(F.col(f"`{id_col}`").alias("id"), F.transform(vector, component).alias("point"))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` points whose ``<seed>:<id>`` has the smallest SHA-256; equal ids by their components, NULL ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.select("point", digest.alias("digest")).orderBy(F.asc_nulls_last("digest"), "point").limit(k).collect()
    return np.array([row["point"] for row in rows], dtype=np.int64)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Arrays of ``sums`` added element by element, exactly, by ``keys`` and ``pos``."""
    return rows.select(*keys, F.posexplode("sums").alias("pos", "part")).groupBy(*keys, "pos").agg(F.sum("part").alias("total"))


def fit_rotation(points: DataFrame, dims: int, leading: int) -> Rotation:
    """Principal axes of all points. Moments are added by task and then by Spark: ``dims * (dims + 1) + 1`` numbers."""

    def moments(batches: Batches) -> Batches:
        total = np.zeros(1 + dims + dims * dims)
        for batch in batches:
            block = _points(batch, dims).astype(np.float64)
            total += np.concatenate([[len(block)], block.sum(axis=0), (block.T @ block).ravel()])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    rows = _summed(points.mapInArrow(moments, "sums array<double>"), []).orderBy("pos").collect()
    totals = np.array([row["total"] for row in rows]) if rows else np.zeros(1 + dims + dims * dims)
    count = max(totals[0], 1.0)
    mean = totals[1 : 1 + dims] / count
    covariance = totals[1 + dims :].reshape(dims, dims) / count - np.outer(mean, mean)
    _, axes = np.linalg.eigh(covariance)
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def rotate(points: DataFrame, rotation: Rotation) -> DataFrame:
    """The points with ``leading`` coordinates and ``residual`` norm."""
    dims = len(rotation.mean)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            leading, residual = rotation.apply(_points(batch, dims))
            columns = [batch.column("id"), batch.column("point")]
            columns += [pa.array(list(leading), pa.list_(pa.float64())), pa.array(residual, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "point", "leading", "residual"])

    kind = points.schema["id"].dataType.simpleString()
    return points.mapInArrow(run, f"id {kind}, point array<int>, leading array<double>, residual double")


def nearest(
    points: np.ndarray, leading: np.ndarray, residual: np.ndarray, centroids: np.ndarray, rotation: Rotation
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each point (the smaller number of equals), its squared distance, and distances measured."""
    its_leading, its_residual = rotation.apply(centroids)
    bound = (residual[:, None] - its_residual[None, :]) ** 2
    norms = (leading**2).sum(axis=1)[:, None] + residual[:, None] ** 2
    norms = norms + ((its_leading**2).sum(axis=1) + its_residual**2)[None, :]
    for axis in range(leading.shape[1]):
        bound += (leading[:, axis, None] - its_leading[None, :, axis]) ** 2
    bound -= _SLACK * norms + 1.0
    cluster = bound.argmin(axis=1)
    distance = ((points - centroids[cluster]) ** 2).sum(axis=1)
    survives = bound <= distance[:, None]
    survives[np.arange(len(points)), cluster] = False
    measured = len(points)
    for number in range(len(centroids)):
        rows = np.flatnonzero(survives[:, number])
        if not len(rows):
            continue
        measured += len(rows)
        exact = ((points[rows] - centroids[number]) ** 2).sum(axis=1)
        better = (exact < distance[rows]) | ((exact == distance[rows]) & (number < cluster[rows]))
        distance[rows[better]], cluster[rows[better]] = exact[better], number
    return cluster, distance, measured


def _assigned(batches: Batches, centroids: np.ndarray, rotation: Rotation) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of ids, points, clusters and distances."""
    dims, width = len(rotation.mean), rotation.axes.shape[1]
    for batch in batches:
        for first in range(0, batch.num_rows, _BLOCK):
            block = batch.slice(first, _BLOCK)
            points = _points(block, dims)
            leading = block.column("leading").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            residual = block.column("residual").to_numpy(zero_copy_only=False)
            cluster, distance, _ = nearest(points, leading, residual, centroids, rotation)
            yield block.column("id"), points, cluster, distance


def _next_centroids(rotated: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """One round: the floor of each cluster's mean; an empty cluster keeps its centroid."""
    k, dims = centroids.shape

    def run(batches: Batches) -> Batches:
        sums = np.zeros((k, dims + 1), dtype=np.int64)
        for _, points, cluster, _ in _assigned(batches, centroids, rotation):
            for number in np.unique(cluster):
                inside = points[cluster == number]
                sums[number, 0] += len(inside)
                sums[number, 1:] += inside.sum(axis=0)
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(used, pa.int32()), "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))}
        )

    parts = rotated.mapInArrow(run, "cluster int, sums array<bigint>")
    parts = parts.withColumn("sums", F.transform("sums", lambda part: part.cast("decimal(38,0)")))
    moved = [[int(value) for value in centroid] for centroid in centroids]
    # At most k * (dims + 1) rows. The exact sums are decimals, whose quotient Python floors exactly.
    totals = {(row["cluster"], row["pos"]): int(row["total"]) for row in _summed(parts, ["cluster"]).collect()}
    for (number, pos), total in totals.items():
        if pos:
            moved[number][pos - 1] = total // totals[number, 0]
    return np.array(moved, dtype=np.int64)


def _final(centroids: np.ndarray, rotation: Rotation) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for ids, _, cluster, distance in _assigned(batches, centroids, rotation):
            columns = [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return run


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    k: int = 8,
    dims: int = 64,
    scale: int = 1024,
    rounds: int = 10,
    seed: int = 3,
    leading: int = 12,
) -> DataFrame:
    """One row per kept vector: its id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` (of the final centroid's components, as decimal integers joined by commas).

    Kept are vectors of exactly ``dims`` components, none of them NULL, NaN or infinite; a NULL vector is not kept.
    Components become integers, and everything that decides is computed in integers, so the result does not depend
    on how rows are split. Rows that repeat count as often as they are there; if they are among the first centroids,
    the later of two equal centroids stays empty and keeps its place. A NULL id is an id that is chosen as a start
    last. With fewer than ``k`` kept vectors each is a start. Other columns are ignored, whatever their names. An
    empty table gives an empty result. A component whose integer is beyond 2**27 ends the job with an error, because
    distances would not fit a long.

    The integers with their rotated coordinates are written once to the shared folder and read by each round; a round
    brings ``k * (dims + 1)`` sums to the driver, whatever the number of vectors.
    """
    spark = vectors.sparkSession
    importable(spark)
    points = integer_points(vectors, id_col, vector_col, dims, scale)
    with scratch_folder(spark, "rotated") as folder:
        centroids = first_centroids(points, k, seed)
        if not len(centroids):
            centroids = np.zeros((1, dims), dtype=np.int64)
        rotation = fit_rotation(points, dims, leading)
        rotated = stage(rotate(points, rotation), folder)
        for _ in range(rounds):
            moved = _next_centroids(rotated, centroids, rotation)
            if np.array_equal(moved, centroids):
                break
            centroids = moved
        kind = points.schema["id"].dataType.simpleString()
        final = rotated.mapInArrow(_final(centroids, rotation), f"id {kind}, cluster int, distance bigint")
        final = stage(final, new_folder(spark, "clusters"))
    totals = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = {row["cluster"]: int(row["total"]) for row in totals}
    whole = sum(inertia.values())
    digests = [hashlib.sha256(",".join(str(int(value)) for value in centroid).encode()).hexdigest() for centroid in centroids]
    per_cluster = spark.createDataFrame(
        [(number, inertia.get(number, 0), whole, digest) for number, digest in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row for each centroid.
    return final.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
