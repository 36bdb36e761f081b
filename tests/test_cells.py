"""The bounded nearest-neighbour join against brute force, on skewed groups and awkward points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.operators.cells import cell_bounds, neighbour_tiles
from fipsight.operators.select import knn_candidates

SCHEMA = "g string, id long, label long, fold int, vec array<double>"


def brute(rows, k):
    """{(group, id): [(distance, neighbour)]} of the k nearest rows of other folds."""
    out = {}
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        X, ids = np.array([r[4] for r in own]), np.array([r[1] for r in own])
        fold = np.array([r[3] for r in own])
        for i, r in enumerate(own):
            d = np.zeros(len(own))
            for c in range(X.shape[1]):
                d += (X[i, c] - X[:, c]) ** 2
            order = [j for j in np.lexsort((ids, d)) if fold[j] != r[3]][:k]
            out[g, r[1]] = [(float(d[j]), int(ids[j])) for j in order]
    return out


def found(df, k, block_rows):
    out = {}
    for r in knn_candidates(df, "g", k=k, block_rows=block_rows).orderBy("dist", "tid").collect():
        out.setdefault((r.g, r.qid), []).append((r.dist, r.tid))
    return out


def clustered(n, dims, clusters, seed, g="hot", first=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims)) * 50
    X = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims))
    return [(g, first + i, int(i % 3), int(rng.integers(0, 4)), X[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("dims,clusters,k", [(2, 12, 3), (6, 5, 5), (1, 1, 2)])
def test_skewed_groups(spark, dims, clusters, k):
    rows = clustered(900, dims, clusters, dims) + clustered(70, dims, 2, 3, None, 5000) + clustered(3, dims, 1, 4, "few", 9000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = {x: v for x, v in brute(rows, k).items() if v}
    assert found(df, k, 32) == want


def test_equal_points_far_points_and_a_rare_fold(spark):
    rows = [("g", i, 0, i % 2, [1.0, 1.0]) for i in range(200)] + [("g", 300 + i, 0, 0, [1e8 + i, -1e8]) for i in range(40)]
    rows += [("g", 400 + i, 0, 1, [0.5 * i, 0.0]) for i in range(60)] + [("one fold", i, 0, 0, [float(i), 0.0]) for i in range(50)]
    rows += [("g", 500, 0, 2, [3.0, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, 4, 16) == {x: v for x, v in brute(rows, 4).items() if v}


def test_empty_table(spark):
    assert knn_candidates(spark.createDataFrame([], SCHEMA), "g", k=3, block_rows=8).count() == 0


def test_clustered_points_travel_less_than_in_all_tiles(spark):
    n, block = 6000, 128
    df = spark.createDataFrame(clustered(n, 3, 60, 9), SCHEMA)
    blocks = -(-n // block)
    rows = neighbour_tiles(df, "g", 5, block)
    assert rows.count() < 0.5 * (2 * n * blocks)  # all pairs of blocks: each point once for every block, on both sides
    assert rows.groupBy("qcell", "_qb", "_tb").count().agg(F.max("count")).first()[0] <= 4 * block


def test_bounds_leave_no_neighbour_out():
    rng = np.random.default_rng(2)
    X, fold, k = rng.normal(size=(300, 2)) * [200, 1], rng.integers(0, 3, 300), 4
    V = X[:12]
    D = np.sqrt(((X[:, None] - V) ** 2).sum(2))
    cell, dist = D.argmin(1), D.min(1)
    radius = np.array([dist[cell == c].max() for c in range(12)])
    near = [(c, f, d) for c in range(12) for f in range(3) for d in np.sort(dist[(cell == c) & (fold == f)])[:k]]
    visits = {i: set() for i in range(12)}
    for i, js, lo, hi in cell_bounds(V, radius, near, [set(fold[cell == c]) for c in range(12)], k):
        for j, a, b in zip(js, lo, hi):
            visits[i] |= set(np.flatnonzero((cell == j) & (dist >= a) & (dist <= b)))
    for q in range(300):
        d = ((X - X[q]) ** 2).sum(1)
        want = [s for s in np.argsort(d, kind="stable") if fold[s] != fold[q]][:k]
        assert set(want) <= visits[cell[q]]
    assert sum(map(len, visits.values())) < 0.7 * 12 * 300
