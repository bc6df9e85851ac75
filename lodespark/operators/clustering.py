"""Lloyd k-means, assignment, within-cluster sum of squares and the elbow sweep."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.operators.select import smallest
from lodespark.staging import spread, stage

ELBOW = (2, 3, 4, 5, 6, 8, 10)


def _block(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The ``coords`` arrays of one Arrow batch as a matrix."""
    coords = batch.column("coords")
    lengths = np.diff(coords.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"every point needs {width} coordinates")
    return coords.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(block: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each center."""
    return np.stack([((block - center) ** 2).sum(axis=1) for center in centers], axis=1)


def _vectors(points: DataFrame) -> DataFrame:
    return points.select("point_id", F.col("coords").cast("array<double>").alias("coords"))


def _first_points(points: DataFrame, k: int) -> np.ndarray:
    rows = points.orderBy("point_id").limit(k).collect()
    if len(rows) < k:
        raise ValueError(f"{len(rows)} points are too few for {k} clusters")
    if len({len(row["coords"]) for row in rows}) > 1:
        raise ValueError("points differ in their number of coordinates")
    return np.array([row["coords"] for row in rows], dtype=float)


def _totals(points: DataFrame, models: dict[int, np.ndarray]) -> DataFrame:
    """Per model, cluster and dimension: number of points and sum of the coordinate.

    Dimension -1 carries the sum of squared distances. Every task adds up its own points
    and hands on one row per sum.
    """
    width = next(iter(models.values())).shape[1]

    def partial(batches):
        sums = {k: np.zeros((k, width + 1)) for k in models}
        counts = {k: np.zeros(k, dtype=np.int64) for k in models}
        for batch in batches:
            block = _block(batch, width)
            for k, centers in models.items():
                distances = _distances(block, centers)
                nearest = distances.argmin(axis=1)
                chosen = np.column_stack([distances.min(axis=1), block])
                sums[k] += (nearest[:, None] == np.arange(k)).T.astype(float) @ chosen
                counts[k] += np.bincount(nearest, minlength=k)
        for k in models:
            yield pa.RecordBatch.from_pydict(
                {
                    "k": np.full(k * (width + 1), k, dtype=np.int32),
                    "cluster_id": np.repeat(np.arange(k, dtype=np.int32), width + 1),
                    "dim": np.tile(np.arange(-1, width, dtype=np.int32), k),
                    "n": np.repeat(counts[k], width + 1),
                    "total": sums[k].ravel(),
                }
            )

    return (
        points.select("coords")
        .mapInArrow(partial, "k int, cluster_id int, dim int, n long, total double")
        .groupBy("k", "cluster_id", "dim")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def _lloyd(points: DataFrame, ks: tuple[int, ...], max_iter: int):
    """Centers and sum of squares for several ``k`` at once.

    All models take their step in the same pass over the points; k x d numbers per
    model return to the driver.
    """
    points = spread(_vectors(points)).persist()
    try:
        first = _first_points(points, max(ks))
        models = {k: first[:k] for k in ks}
        for _ in range(max_iter):
            moved = {k: centers.copy() for k, centers in models.items()}
            for row in _totals(points, models).where("dim >= 0 and n > 0").collect():
                moved[row["k"]][row["cluster_id"], row["dim"]] = row["total"] / row["n"]
            models = moved
        squares = _totals(points, models).where("dim = -1").groupBy("k").agg(
            F.sum("total").alias("wcss")
        )
        return models, {row["k"]: float(row["wcss"]) for row in squares.collect()}
    finally:
        points.unpersist()


def kmeans(points: DataFrame, k: int, max_iter: int) -> tuple[DataFrame, float]:
    """Centroids ``(cluster_id, center)`` and their within-cluster sum of squares.

    The first ``k`` points by id start the run, which takes exactly ``max_iter`` steps.
    A cluster without points keeps its centroid; ties go to the lowest cluster.
    """
    models, squares = _lloyd(points, (k,), max_iter)
    rows = [(n, [float(x) for x in center]) for n, center in enumerate(models[k])]
    spark = points.sparkSession
    return spark.createDataFrame(rows, "cluster_id int, center array<double>"), squares[k]


def elbow(points: DataFrame, ks: tuple[int, ...] = ELBOW, max_iter: int = 20) -> DataFrame:
    """``(k, wcss)`` for every ``k``."""
    _, squares = _lloyd(points, tuple(ks), max_iter)
    rows = [(k, squares[k]) for k in ks]
    return points.sparkSession.createDataFrame(rows, "k int, wcss double")


def assign(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """``(point_id, coords, cluster_id, distance)`` with the squared distance.

    The centroids, k rows, are sent along with the task.
    """
    rows = centroids.orderBy("cluster_id").collect()
    centers = np.array([row["center"] for row in rows], dtype=float)
    ids = np.array([row["cluster_id"] for row in rows], dtype=np.int32)

    def nearest(batches):
        for batch in batches:
            distances = _distances(_block(batch, centers.shape[1]), centers)
            chosen = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("point_id"),
                    batch.column("coords"),
                    pa.array(ids[chosen]),
                    pa.array(distances.min(axis=1)),
                ],
                names=["point_id", "coords", "cluster_id", "distance"],
            )

    points = spread(_vectors(points))
    id_type = points.schema["point_id"].dataType.simpleString()
    return points.mapInArrow(
        nearest,
        f"point_id {id_type}, coords array<double>, cluster_id int, distance double",
    )


def wcss(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row with the sum of squared distances to the nearest centroid."""
    return assign(points, centroids).agg(F.sum("distance").alias("wcss"))


def sample(
    points: DataFrame,
    centroids: DataFrame,
    n: int = 5000,
    dims: tuple[int, int] = (1, 4),
) -> DataFrame:
    """Two coordinates and the cluster of the first ``n`` points by id, a whole number."""
    first = stage(smallest(points, F.col("point_id"), ["point_id"], n))
    chosen = assign(first, centroids)
    x, y = dims
    return chosen.select(
        "point_id", "cluster_id", F.col("coords")[x].alias("x"), F.col("coords")[y].alias("y")
    )
