"""Split trees: recall against the exact search, hot vectors, empty tables, no pairs put out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import neighbours
from tallyloom.operators.neighbours import knn_approx, knn_exact


def recall(exact, near):
    exact, near = exact.select("query_id", "neighbour_id"), near.select("query_id", "neighbour_id")
    return exact.intersect(near).count() / exact.count()


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, size):
    t = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")
    asked = t.where("vec_id % 10 = 0")
    near = knn_approx(t, asked, "vec_id", "embedding", 10).cache()
    exact = knn_exact(t, asked, "vec_id", "embedding", 10)
    assert recall(exact, near) >= 0.9
    assert near.groupBy("query_id").count().where("count <> 10").count() == 0


def test_hot_vectors_and_radius(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 4
    points = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16))
    points[:2000] = points[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(9999, None)], "id long, v array<double>")
    asked = df.where("id % 50 = 0")
    near = knn_approx(df, asked, "id", "v", 5, leaf=128, block=64)
    known = df.where("v IS NOT NULL")
    assert recall(knn_exact(known, known.where("id % 50 = 0"), "id", "v", 5), near) >= 0.9
    hot = near.where("query_id = 1000").orderBy("rank").collect()
    assert [(r.neighbour_id, r.distance) for r in hot] == [(i, 0.0) for i in range(5)]
    close = knn_approx(df, asked, "id", "v", 5, radius=2.0, leaf=128)
    assert close.agg(F.max("distance")).first()[0] <= 4.0
    assert knn_approx(df.limit(0), asked, "id", "v", 5).count() == 0
    assert knn_approx(df, asked.limit(0), "id", "v", 5).count() == 0


def test_exact_search_holds_ties_copies_and_limits_in_small_pieces(spark):
    """Cells of a few rows, so every query goes elsewhere as well; no table that all cells rule in leaves a task at once."""
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(700, 6)), 1)
    points[100:160] = points[0]
    points[300:420] = points[300] + np.eye(6)[rng.integers(0, 6, 120)]  # many at one distance
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    found = {(r.query_id, r["rank"]): r.neighbour_id for r in knn_exact(df, df, "id", "v", 5, block=16).collect()}
    apart = np.round(((points[:, None] - points) ** 2).sum(2), 9)
    wanted = np.array([np.lexsort((np.arange(len(points)), row))[:5] for row in apart])
    assert len(found) == wanted.size
    assert all(found[i, n + 1] == j for i, row in enumerate(wanted) for n, j in enumerate(row))
    assert knn_exact(df.limit(0), df, "id", "v", 5).count() == 0
    assert knn_exact(df, df.limit(0), "id", "v", 5).count() == 0


def test_exact_search_works_on_few_tiles_at_once():
    rng = np.random.default_rng(6)
    base, asked = rng.random((20000, 3)), rng.random((3000, 3))
    search = neighbours.Search(base, 2, 256)
    visited = []
    real, neighbours._gap = neighbours._gap, lambda low, high, *boxes: (visited.append(boxes[0].ndim == 1), real(low, high, *boxes))[1]
    try:
        i, j, d = search.nearest(asked, np.full(3000, np.inf))
    finally:
        neighbours._gap = real
    assert sum(visited) < 0.3 * visited.count(False) * len(search.tiles)
    apart = np.array([((base - a) ** 2).sum(1) for a in asked])
    assert np.allclose(d, apart[i, j]) and np.allclose(d.reshape(3000, 2), np.partition(apart, 1, axis=1)[i[::2], :2])
