"""k-means against NumPy."""

from __future__ import annotations

import numpy as np
import pytest

from lodespark.operators import clustering


def points(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "point_id long, coords array<double>")


def lloyd(data, k, steps):
    centers = data[:k].copy()
    for _ in range(steps):
        nearest = ((data[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        for j in range(k):
            if (nearest == j).any():
                centers[j] = data[nearest == j].mean(axis=0)
    return centers, ((data[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()


def test_matches_numpy_and_never_gets_worse(spark):
    data = np.random.RandomState(0).normal(size=(200, 5))
    df = points(spark, data.tolist())
    before = np.inf
    for steps in (0, 1, 4):
        centroids, wcss = clustering.kmeans(df, 4, steps)
        centers, expected = lloyd(data, 4, steps)
        found = [r["center"] for r in centroids.orderBy("cluster_id").collect()]
        assert np.allclose(found, centers)
        assert wcss == pytest.approx(expected)
        assert wcss <= before
        before = wcss
    assert clustering.wcss(df, centroids).first()[0] == pytest.approx(before)


def test_elbow(spark):
    data = np.random.RandomState(1).normal(size=(60, 3))
    rows = clustering.elbow(points(spark, data.tolist()), (2, 3, 5), 3).collect()
    assert [r["k"] for r in rows] == [2, 3, 5]
    for row in rows:
        assert row["wcss"] == pytest.approx(lloyd(data, row["k"], 3)[1])


def test_empty_cluster_keeps_its_center_and_ties_go_low(spark):
    df = points(spark, [[0.0], [0.0], [4.0], [2.0]])
    centroids, _ = clustering.kmeans(df, 3, 1)
    assert [r["center"] for r in centroids.orderBy("cluster_id").collect()] == [[2 / 3], [0.0], [4.0]]
    fixed = spark.createDataFrame([(0, [0.0]), (1, [4.0])], "cluster_id int, center array<double>")
    near = {r["point_id"]: r["cluster_id"] for r in clustering.assign(df, fixed).collect()}
    assert near == {0: 0, 1: 0, 2: 1, 3: 0}


def test_bad_input(spark):
    with pytest.raises(ValueError):
        clustering.kmeans(points(spark, [[1.0]]), 2, 1)
    with pytest.raises(Exception, match="coordinates"):
        clustering.kmeans(points(spark, [[1.0], [2.0], [1.0, 2.0]]), 2, 1)


def test_sample_takes_the_first_points(spark):
    data = np.arange(50, dtype=float).reshape(10, 5)
    df = points(spark, data.tolist())
    centroids, _ = clustering.kmeans(df, 2, 1)
    rows = clustering.sample(df, centroids, 4).orderBy("point_id").collect()
    assert [(r["point_id"], r["x"], r["y"]) for r in rows] == [
        (n, 5.0 * n + 1, 5.0 * n + 4) for n in range(4)
    ]
