"""Cost and rules of the search inside one group, and of summaries of many groups."""

import numpy as np
import pyarrow as pa

from fipsight.operators import frequent
from fipsight.operators.cells import nearest_from_distances, nearest_in_order, sq_dist
from fipsight.operators.frequent import feature_screen, value_summaries
from fipsight.operators.profile import feature_histogram, frequency_screen
from fipsight.operators.select import _group_scorer, _majority


def plain_score(X, fold, ids, labels, k, idx):
    """Mean fold accuracy as defined: all distances, ties to the smaller id, then a vote."""
    D = sq_dist(X[:, idx], X[:, idx])
    r, c, _ = nearest_from_distances(D, fold, fold, ids, k)
    pred, voted = _majority(r, labels[c], len(X))
    return float(np.mean([(pred == labels)[voted & (fold == f)].mean() for f in np.unique(fold[voted])]))


def test_scores_with_ties_one_fold_groups_and_infinite_features():
    rng = np.random.default_rng(5)
    for n, folds, k in ((120, 5, 2), (60, 2, 3), (40, 1, 2), (7, 5, 9)):
        X = rng.integers(0, 4, (n, 3)).astype(float)
        X[0, 1] = np.inf
        fold, ids, y = rng.integers(0, folds, n), rng.permutation(n), rng.integers(0, 3, n)
        score = _group_scorer(X, fold, ids, y, k)
        with np.errstate(invalid="ignore"):
            for idx in ([0], [1], [0, 1], [2, 0], [0, 2, 1]):
                want = plain_score(X, fold, ids, y, k, idx) if folds > 1 else float("nan")
                np.testing.assert_allclose(score(idx), want, rtol=1e-12)


def test_nearest_in_order_gives_ties_to_the_smaller_column():
    at, dist = nearest_in_order(np.array([[2.0, 1.0, 1.0, 1.0], [np.inf, 5.0, np.inf, np.inf]]), 2)
    assert at[0].tolist() == [1, 2] and at[1, 0] == 1
    assert dist.tolist() == [[1.0, 1.0], [5.0, np.inf]]


def test_a_task_with_many_groups_sums_no_row_again_with_every_batch(spark, monkeypatch):
    monkeypatch.setattr(frequent, "HELD_ROWS", 400)
    rng = np.random.default_rng(3)
    rows = [(int(i % 300) if i % 11 else None, float(rng.integers(0, 3)), float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, few double, many double").coalesce(1)
    read = []
    monkeypatch.setattr(frequent, "_sum", lambda t, by, plain=frequent._sum: (read.append(len(t)), plain(t, by))[1])
    batches = [pa.RecordBatch.from_pydict({"_k0": pa.array([r[0] for r in rows[i:i + 50]], pa.int32()),
                                           "_v0": pa.array([r[1] for r in rows[i:i + 50]])}) for i in range(0, 4000, 50)]
    held = {}
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, schema: held.update(fn=fn) or (_ for _ in ()).throw(StopIteration()))
    try:
        value_summaries(df, "g", ["few"], 4)
    except (StopIteration, RuntimeError):
        pass
    given = sum(b.num_rows for b in held["fn"](iter(batches)))
    assert given and sum(read) < 8 * len(rows)  # before: every batch summed all held counters again


def test_screen_of_many_groups_with_early_summaries(spark, monkeypatch):
    monkeypatch.setattr(frequent, "HELD_ROWS", 100)
    rng = np.random.default_rng(4)
    rows = [(int(i % 90) if i % 13 else None, float(rng.integers(0, 3)), float(i), None if i % 2 else 1.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, few double, many double, half double").repartition(3)
    cols = ["few", "many", "half"]
    want = frequency_screen(feature_histogram(df, "g", cols), "g")
    assert sorted(map(str, feature_screen(df, "g", cols).collect())) == sorted(map(str, want.collect()))
