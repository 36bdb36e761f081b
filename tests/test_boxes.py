"""The k-d box join against brute force, and its work."""

import numpy as np
import pytest

from fipsight.operators import boxes
from fipsight.operators.boxes import boxes_of, boxes_within, build_tree, site_neighbours
from fipsight.operators.rounds import round_counts
from fipsight.operators.select import knn_fold_counts

SCHEMA = "g string, id long, label long, fold int, vec array<double>"


def brute(rows, k):
    X, ids, fold = np.array([r[4] for r in rows]), np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
    out = {}
    for x, r in zip(X, rows):
        d = np.zeros(len(X))
        for c in range(X.shape[1]):
            d += (x[c] - X[:, c]) ** 2
        out[r[3], tuple(r[4])] = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if fold[j] != r[3]][:k]
    return out


@pytest.mark.parametrize("dims", [1, 3])
def test_lattice_points_and_folds_that_follow_the_ids(spark, dims):
    """Ties everywhere, copies, and a feature that is the id, so that a fold is a range of it."""
    rng = np.random.default_rng(dims)
    rows = [(None, i, int(rng.integers(0, 3)), i * 5 // 1500, [float(v) for v in [i // 2, *rng.integers(0, 6, dims - 1)]]) for i in range(1500)]
    rows += [(None, 2000 + i, 1, i % 2, [7.0] * dims) for i in range(200)] + [(None, 3000, 1, 0, [float("inf")] * dims)]
    got = site_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(3), "g", 4, 32).collect()
    assert {(r.fold, tuple(r.vec)): [(n.dist, n.tid) for n in r.near] for r in got} == brute(rows[:-1], 4)


def test_few_boxes_are_visited():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(20_000, 2))
    tree = build_tree(X[::10])
    box = boxes_of(tree, X)
    assert np.bincount(box).max() < 400 and box.max() > 150
    row, seen = boxes_within(tree, X[:500], np.full(500, 0.0025))
    assert len(row) < 6 * 500
    inside = set(zip(row.tolist(), seen.tolist()))
    for q in range(500):
        assert all((q, b) in inside for b in set(box[((X - X[q]) ** 2).sum(1) <= 0.0025].tolist()))


def test_rows_of_a_round_follow_the_points(spark, monkeypatch):
    """Rows that meet in tiles: a fixed multiple of the points, where pairs of blocks grew with their square."""
    met = {}
    for n in (1500, 6000):
        rng = np.random.default_rng(n)
        rows = [("g", i, int(rng.integers(0, 3)), i % 5, [float(v) for v in rng.normal(size=2)], n) for i in range(n)]
        points = spark.createDataFrame(rows, "g string, id long, label long, fold int, x array<double>, _gn long")
        state = spark.createDataFrame([("g", n, [0, 1], [0], 0)], "g string, _gn long, pool array<int>, subset array<int>, added int")
        found = []
        plain = boxes._nearest_in_boxes
        monkeypatch.setattr(boxes, "_nearest_in_boxes", lambda q, *a: (found.append(q.count()), plain(q, *a))[1])
        counts = {r.fold: (r.n_test, r.n_correct) for r in round_counts(points, state, ["g"], 2, 2, 64).collect()}
        monkeypatch.undo()
        whole = spark.createDataFrame([r[:5] for r in rows], SCHEMA)
        assert counts == {r.fold: (r.n_test, r.n_correct) for r in knn_fold_counts(whole, "g", 2, block_rows=n).collect()}
        met[n] = sum(found)
    assert met[6000] < 5 * met[1500]
