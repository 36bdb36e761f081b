"""The whole search of a group in one task: its folds, its work, and rows that share an id."""

import numpy as np
import pytest

from fipsight.operators import select
from fipsight.operators.select import _group_folds, _group_scorer, _search_group, select_features_knn, stratified_folds
from test_search_cost import plain_score


def test_folds_of_a_group_are_those_of_the_sorted_table(spark):
    rng = np.random.default_rng(1)
    rows = [(g, int(i), int(y)) for g, n in (("a", 61), (None, 40), ("c", 3))
            for i, y in zip(rng.permutation(1000)[:n], rng.integers(-1, 4, n))]
    df = spark.createDataFrame(rows, "g string, id long, label long").repartition(4)
    for folds in (5, 3, 1):
        want = {(r.g, r.id): r.fold for r in stratified_folds(df, "g", "label", "id", folds).collect()}
        got = {}
        for g in ("a", None, "c"):
            ids, labels = (np.array([r[c] for r in rows if r[0] == g]) for c in (1, 2))
            got |= {(g, int(i)): int(f) for i, f in zip(ids, _group_folds(ids, labels, folds))}
        assert got == want


def test_small_groups_are_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(select, "distributed_row_number", None)  # their folds need no sorted table
    rng = np.random.default_rng(2)
    rows = [(int(i % 3) or None, i, int(rng.integers(0, 2)), *map(float, rng.integers(0, 4, 2))) for i in range(90)]
    df = spark.createDataFrame(rows, "g int, id long, y int, a double, b double")
    got = select_features_knn(df, "g", "id", "y", ["a", "b"], k=1).collect()
    assert {r.g for r in got} == {None, 1, 2} and all(r.status == "ok" and r.n == 30 and r.score for r in got)


def test_equal_rows_are_not_compared_with_all_others(monkeypatch):
    rng = np.random.default_rng(3)
    X, n = rng.integers(0, 6, (500, 4)).astype(float), 500
    X[:, 3] = rng.normal(size=n)
    fold, y, ids = rng.integers(0, 5, n), rng.integers(0, 3, n), rng.permutation(n)
    met = []
    plain = select.nearest_in_order
    monkeypatch.setattr(select, "nearest_in_order", lambda D, k: (met.append(D.size), plain(D, k))[1])
    subset, score = _search_group(_group_scorer(X, fold, ids, y, 2), [0, 1, 2], 2)
    assert sum(met) < n * n // 2  # before: five subsets of n * n
    assert score == pytest.approx(plain_score(X, fold, ids, y, 2, subset))
    for idx in ([0, 3], [3], [0, 1, 2], [2, 1, 0]):
        np.testing.assert_allclose(_group_scorer(X, fold, ids, y, 2)(idx), plain_score(X, fold, ids, y, 2, idx), rtol=1e-12)


def test_unequal_values_whose_squared_difference_vanishes():
    X = np.array([[0.0], [1e-200], [2e-200], [0.0], [1e-200], [5.0]])
    fold, y, ids = np.array([0, 1, 0, 1, 0, 1]), np.array([1, 2, 1, 2, 2, 1]), np.array([5, 4, 3, 2, 1, 0])
    assert _group_scorer(X, fold, ids, y, 1)([0]) == pytest.approx(plain_score(X, fold, ids, y, 1, [0]))


def test_rows_that_share_an_id_come_in_one_order(spark):
    rng = np.random.default_rng(4)
    rows = [("g", int(i // 3), int(rng.integers(0, 3)), *map(float, rng.integers(0, 3, 3))) for i in range(200)]
    schema = "g string, id long, y int, a double, b double, c double"
    got = {str(select_features_knn(spark.createDataFrame([rows[i] for i in rng.permutation(200)], schema).repartition(p),
                                   "g", "id", "y", ["a", "b", "c"], k=2).collect()) for p in (1, 3, 7)}
    assert len(got) == 1
