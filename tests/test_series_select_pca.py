"""Series windows, overlap, AR forecast, KNN cross-validation, selection and PCA vs numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.operators import series
from fipsight.operators.decompose import explained_variance, loadings, pca_fit, pca_scores, significance
from fipsight.operators.forecast import fit_ar, predict_ar
from fipsight.operators.select import (distributed_row_number, floating_forward, knn_cv_accuracy,
                                       stratified_folds)


def _series(spark, n, key="a"):
    return spark.createDataFrame([(key, i, float(i * i % 17)) for i in range(n)],
                                 "fips string, t int, aqi double")


@pytest.mark.parametrize("n,want", [(14, 0), (15, 0), (16, 1), (40, 25)])
def test_window_counts(spark, n, want):
    w = series.sliding_windows(_series(spark, n), "fips", "t", "aqi")
    rows = w.orderBy("start").collect()
    assert len(rows) == max(n - 15, 0) == want
    if rows:
        vals = [float(i * i % 17) for i in range(n)]
        assert rows[0].inputs == vals[0:10] and rows[0].targets == vals[10:15]
        assert rows[-1].start == n - 16


def test_tail_holdout(spark):
    w = series.sliding_windows(_series(spark, 40), "fips", "t", "aqi")
    h = series.tail_holdout(w, "fips", n_test=5)
    assert sorted(r.start for r in h.where("is_test").collect()) == [20, 21, 22, 23, 24]


def test_overlap_fixture(spark):
    # six windows x five steps; prediction value encodes (window, step)
    rows = [("a", s, [float(10 * s + h) for h in range(5)]) for s in range(6)]
    df = spark.createDataFrame(rows, "fips string, start int, pred array<double>")
    got = {r.pos: r.pred for r in series.overlap_resolve(df, "fips").collect()}
    assert len(got) == 6 + 4
    for p in range(6):
        assert got[p] == 10 * p                      # step 1 of window p
    for p in range(6, 10):
        assert got[p] == 10 * 5 + (p - 5)            # steps 2..5 of the last window
    avg = {r.pos: r.pred for r in series.overlap_resolve(df, "fips", how="avg").collect()}
    assert avg[0] == 0.0 and avg[1] == np.mean([10, 1])


def test_forecast_error(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], [2.0, 0.0])], "k string, targets array<double>, pred array<double>")
    r = series.forecast_error(df, "k").first()
    assert (r.n, r.mae, r.mse) == (2, 1.5, 2.5)


def test_ar_recovers_linear_recurrence(spark):
    # y_t = 0.5 y_{t-1} + 0.3 y_{t-2} + 1 + noise-free seasonal driver is exactly learnable
    rng = np.random.default_rng(3)
    y = list(rng.normal(size=10))
    for t in range(10, 400):
        y.append(0.5 * y[-1] + 0.3 * y[-2] + 1.0 + 0.0 * t)
    y = [v + 1e-3 * rng.normal() for v in y]
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "k string, t int, v double")
    w = series.sliding_windows(df, "k", "t", "v")
    coef = fit_ar(w, "k")
    pred = predict_ar(w, coef, "k").collect()
    err = np.mean([abs(a - b) for r in pred for a, b in zip(r.targets, r.pred)])
    assert err < 0.05
    # numpy check of step-1 coefficients
    X = np.array([[1.0] + r.inputs for r in w.orderBy("start").collect()])
    Y = np.array([r.targets[0] for r in w.orderBy("start").collect()])
    c = coef.first().coef[0]
    assert np.allclose(c, np.linalg.lstsq(X, Y, rcond=None)[0], atol=1e-6)


def _sk_folds(labels, folds):
    """Reference rule of StratifiedKFold(shuffle=False), written out in numpy."""
    classes, y = np.unique(labels, return_inverse=True)
    order = np.sort(y)
    alloc = np.asarray([np.bincount(order[i::folds], minlength=len(classes)) for i in range(folds)])
    out = np.empty(len(y), dtype=int)
    for c in range(len(classes)):
        out[y == c] = np.arange(folds).repeat(alloc[:, c])
    return out


def test_distributed_row_number(spark):
    rows = [("g%d" % (i % 3 if i < 200 else 0), i) for i in range(260)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(5)
    got = {r.id: r.rn for r in distributed_row_number(df, "g", ["id"]).collect()}
    for gname in ("g0", "g1", "g2"):
        ids = sorted(i for g, i in rows if g == gname)
        assert [got[i] for i in ids] == list(range(len(ids)))


def test_stratified_folds_match_reference_rule(spark):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 4, size=137)
    df = spark.createDataFrame([(0, i, int(l)) for i, l in enumerate(labels)], "grp int, id long, label long")
    got = {r.id: r.fold for r in stratified_folds(df, "grp", "label", "id", 5).collect()}
    want = _sk_folds(labels, 5)
    assert [got[i] for i in range(len(labels))] == list(want)


def _knn_brute(X, labels, folds, k):
    acc = {}
    for f in range(folds.max() + 1):
        te, tr = np.where(folds == f)[0], np.where(folds != f)[0]
        ok = 0
        for i in te:
            d = ((X[tr] - X[i]) ** 2).sum(1)
            nn = tr[np.lexsort((tr, d))[:k]]
            vals, cnt = np.unique(labels[nn], return_counts=True)
            ok += int(vals[np.argmax(cnt)] == labels[i])
        acc[f] = ok / len(te)
    return acc


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_knn_cv_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(11)
    n = 120
    X = rng.normal(size=(n, 3))
    labels = (X[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(int) + (X[:, 1] > 1).astype(int)
    df = spark.createDataFrame([(0, i, int(labels[i]), *map(float, X[i])) for i in range(n)],
                               "grp int, id long, label long, a double, b double, c double")
    res = {r.fold: r.accuracy for r in knn_cv_accuracy(df, "grp", "id", "label", ["a", "b", "c"],
                                                       k=5, folds=5, block_rows=block_rows).collect()}
    want = _knn_brute(X, labels, _sk_folds(labels, 5), 5)
    assert res == pytest.approx(want)


def test_floating_forward_finds_planted_subset():
    rng = np.random.default_rng(2)
    X = rng.normal(size=(500, 6))
    y = X[:, 1] + 0.8 * X[:, 4] - 0.6 * X[:, 2] + 0.1 * rng.normal(size=500)
    Z = (X - X.mean(0)) / X.std(0)
    yz = (y - y.mean()) / y.std()
    R = Z.T @ Z / 500
    r = Z.T @ yz / 500
    chosen, score = floating_forward(R, r, 3)
    assert chosen == [1, 2, 4] and score > 0.95


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(80, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(80)], "id long, v array<double>")
    fit = pca_fit(df, "v", 3, keep=["id"])
    Z = (X - X.mean(0)) / X.std(0)                      # population std, as the original analysis
    evals, evecs = np.linalg.eigh(np.cov(Z, rowvar=False))
    order = np.argsort(evals)[::-1][:3]
    evals, evecs = evals[order], evecs[:, order]
    for j in range(3):
        if evecs[np.argmax(np.abs(evecs[:, j])), j] < 0:
            evecs[:, j] *= -1
    assert np.allclose(fit.components, evecs, atol=1e-8)
    assert np.allclose(fit.variance, evals, rtol=1e-8)
    assert np.allclose(fit.ratio, evals / np.trace(np.cov(Z, rowvar=False)), rtol=1e-8)
    sc = {r.id: r.scores for r in pca_scores(fit, keep=["id"]).collect()}
    want = Z @ evecs
    assert np.allclose(np.array([sc[i] for i in range(80)]), want, atol=1e-8)
    ld = {(r.feature, r.component): r.loading for r in loadings(spark, fit).collect()}
    assert np.isclose(ld[("f0", 0)], evecs[0, 0] * np.sqrt(evals[0]))
    cum = [r.cumulative for r in explained_variance(spark, fit).orderBy("component").collect()]
    assert np.allclose(cum, np.cumsum(fit.ratio))
    sig = significance(loadings(spark, fit)).collect()
    assert sig[0].significance >= sig[-1].significance


def _sffs_knn_reference(X, labels, k, n_neighbors, folds=5):
    """Plain-Python floating forward selection with the same KNN cross-validation."""
    fold_ids = _sk_folds(labels, folds)

    def score(sub):
        return float(np.mean(list(_knn_brute(X[:, sub], labels, fold_ids, n_neighbors).values())))

    p = X.shape[1]
    subset, best = [], {}
    while len(subset) < k:
        s, f = max((score(subset + [f]), -f) for f in range(p) if f not in subset)
        added = -f
        subset = subset + [added]
        if len(subset) not in best or s > best[len(subset)][0]:
            best[len(subset)] = (s, sorted(subset))
        while len(subset) > 2:
            s2, x = max((score([y for y in subset if y != x]), -x) for x in subset if x != added)
            if s2 > best[len(subset) - 1][0]:
                subset = [y for y in subset if y != -x]
                best[len(subset)] = (s2, sorted(subset))
            else:
                break
    return best[k]


def test_select_features_knn_matches_reference(spark):
    from fipsight.operators.select import select_features_knn
    rng = np.random.default_rng(21)
    n, p = 60, 5
    X = rng.integers(0, 4, size=(n, p)).astype(float)
    labels = ((X[:, 1] + X[:, 3] + rng.integers(0, 2, size=n)) > 3).astype(int)
    rows = [("c", i, int(labels[i]), *map(float, X[i])) for i in range(n)]
    rows += [("small", 100 + i, 0, 1.0, 2.0, 3.0, 4.0, 5.0) for i in range(5)]
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, "g string, id long, y long, " + ", ".join(f"{c} double" for c in names))
    res = {r.g: r for r in select_features_knn(df, "g", "id", "y", names, k=3, n_neighbors=2).collect()}
    want_score, want_subset = _sffs_knn_reference(X, labels, 3, 2)
    assert res["c"].status == "ok"
    assert res["c"].features == [names[i] for i in want_subset]
    assert abs(res["c"].score - want_score) < 1e-12
    assert res["small"].status == "too_few_rows" and res["small"].features == []


def test_select_features_knn_tiled_path_agrees(spark):
    """Same search with groups forced through the replicated, tiled path (block_rows tiny)."""
    from fipsight.operators.select import select_features_knn
    rng = np.random.default_rng(4)
    n, p = 45, 4
    X = rng.integers(0, 3, size=(n, p)).astype(float)
    labels = ((X[:, 0] + rng.integers(0, 2, size=n)) > 1).astype(int)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([("c", i, int(labels[i]), *map(float, X[i])) for i in range(n)],
                               "g string, id long, y long, " + ", ".join(f"{c} double" for c in names))
    one = select_features_knn(df, "g", "id", "y", names, k=2, n_neighbors=3).first()
    tiled = select_features_knn(df, "g", "id", "y", names, k=2, n_neighbors=3, block_rows=8).first()
    want_score, want_subset = _sffs_knn_reference(X, labels, 2, 3)
    assert one.features == tiled.features == [names[i] for i in want_subset]
    assert abs(one.score - want_score) < 1e-12 and abs(tiled.score - want_score) < 1e-12
