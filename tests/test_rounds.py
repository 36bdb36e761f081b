"""The search in rounds over tiles against the search of a whole group in one task."""

import itertools

import numpy as np
import pytest

from fipsight.operators.rounds import candidates, step, vote
from fipsight.operators.select import _search_group, select_features_knn

NAMES = list("abcdef")


@pytest.mark.parametrize("seed", range(12))
def test_steps_follow_the_search_of_one_group(seed):
    rng = np.random.default_rng(seed)
    table = {s: float(v) for s, v in zip((frozenset(c) for r in range(1, 7) for c in itertools.combinations(range(6), r)),
                                         rng.integers(0, 12, 63) / 12)}  # many ties
    for k in (1, 2, 3, 5, 6):
        pool = list(range(6))
        state = {"pool": pool, "subset": [], "added": -1, "done": False, "best": []}
        rounds = 0
        while not state["done"]:
            scores = {c: table[frozenset(s)] for c, s in candidates(pool, state["subset"], state["added"], k).items()}
            state = step(state, scores, k)
            rounds += 1
        got = next(b for b in state["best"] if b["size"] == k)
        assert (got["subset"], got["score"]) == _search_group(lambda s: table[frozenset(s)], pool, k)
        assert rounds < 60


def test_votes():
    labels = np.array([[3, 1, 1, 3], [5, 5, 2, 2], [7, 1, 1, 1], [9, 9, 9, 9]])
    valid = np.array([[True] * 4, [True, True, True, False], [True, False, False, False], [False] * 4])
    assert vote(labels, valid)[:3].tolist() == [1, 5, 7]


def test_rounds_equal_one_task(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n, noise in ((None, 90, 0.3), ("p", 130, 1.0), ("q", 75, 3.0)):
        X = rng.normal(size=(n, 6))
        X[:, 3] = np.round(X[:, 3])
        y = ((X[:, 1] * X[:, 2] + X[:, 3] + rng.normal(size=n) * noise) > 0).astype(int)
        rows += [(g, 1000 * len(rows) + i, int(y[i]), *map(float, X[i])) for i in range(n)]
    rows += [("one label", 10 ** 6 + i, 1, *map(float, rng.normal(size=6))) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, id long, y int, " + ", ".join(f"{c} double" for c in NAMES)).repartition(5)
    one, many = ({r.g: (r.features, r.score, r.n, r.status) for r in
                  select_features_knn(df, "g", "id", "y", NAMES, k=4, n_neighbors=3, block_rows=b).collect()} for b in (1024, 24))
    assert one == many and len(one) == 4 and all(v[3] == "ok" for v in one.values())
