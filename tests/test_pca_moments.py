"""One-pass co-moments and the fits on them: odd rows, many tasks, large means, one scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.operators import decompose
from fipsight.operators.decompose import (column_moments, explained_variance, loadings, merge_moments, pca_fit, pca_scores,
                                          significance)


def frame(spark, X, parts=7):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, v array<double>").repartition(parts)


@pytest.mark.parametrize("shift,parts", [(0.0, 3), (1e7, 40), (-1e4, 1)])
def test_moments_equal_numpy(spark, monkeypatch, shift, parts):
    monkeypatch.setattr(decompose, "FAN", 4)
    X = np.random.default_rng(1).normal(size=(500, 6)) * [1, 2, 3, 1e3, 1e-3, 1] + shift
    n, mean, cov = column_moments(frame(spark, X, parts).select(F.col("v").alias("_a")), 6)
    assert n == 500
    np.testing.assert_allclose(mean, X.mean(0), rtol=1e-12)
    np.testing.assert_allclose(cov, np.cov(X.T, bias=True), rtol=1e-6, atol=1e-8 * max(1, abs(shift)) ** 0.5)


def test_merge_of_any_split():
    X = np.random.default_rng(2).normal(size=(90, 4)) + 50
    parts = [decompose._moments(X[a:b]) for a, b in ((0, 1), (1, 40), (40, 41), (41, 90))]
    n, mean, co = merge_moments(iter(parts))
    assert n == 90 and np.allclose(mean, X.mean(0)) and np.allclose(co / 90, np.cov(X.T, bias=True)[np.triu_indices(4)])
    assert merge_moments(iter([])) is None


def test_infinite_and_missing_values_take_no_part(spark):
    X = np.random.default_rng(3).normal(size=(60, 3))
    whole = frame(spark, X)
    odd = spark.createDataFrame([(100, [1.0, float("inf"), 0.0]), (101, [1.0, float("nan"), 0.0]), (102, [1.0, None, 0.0]),
                                 (103, [1.0]), (104, None), (105, [])], whole.schema)
    f, g = pca_fit(whole, "v", 2, keep=["id"]), pca_fit(whole.unionByName(odd), "v", 2, keep=["id"])
    assert g.n == 60 and np.allclose(f.components, g.components) and np.allclose(f.variance, g.variance)
    got = {r.id: r.scores for r in pca_scores(g, keep=["id"]).collect()}
    assert all(got[i] is None for i in range(100, 106)) and all(len(got[i]) == 2 for i in range(60))


def test_constant_columns_and_empty_tables(spark):
    X = np.random.default_rng(4).normal(size=(30, 3))
    X[:, 1] = 0.1
    fit = pca_fit(frame(spark, X), "v", 3)
    assert np.isclose(fit.ratio.sum(), 1) and np.allclose(fit.components[1], [0, 0, fit.components[1, 2]])
    assert {r.feature: r.significance for r in significance(loadings(spark, fit)).collect()}["f1"] == pytest.approx(0, abs=1e-9)
    for empty in (pca_fit(frame(spark, X).where("false"), ["id"], 1, keep=["id"]), pca_fit(frame(spark, X).where("false"), "v", 2, keep=["id"])):
        assert empty.n == 0 and pca_scores(empty, keep=["id"]).count() == 0
        assert all(r.ratio == 0 for r in explained_variance(spark, empty).collect())
    one = pca_fit(frame(spark, X[:1]), "v", 2, keep=["id"])
    assert one.n == 1 and not one.variance.any() and pca_scores(one, keep=["id"]).first().scores == [0.0, 0.0]


def test_keys_and_text_columns_are_carried(spark):
    df = spark.createDataFrame([(2 ** 53 + 1, "a", 1.0, 2.0), (None, None, 2.0, 1.0), (3, "c", 0.0, 5.0)], "id long, s string, x double, y double")
    got = pca_scores(pca_fit(df, ["x", "y"], 1, keep=["id", "s"]), keep=["id", "s"])
    assert {(r.id, r.s) for r in got.collect()} == {(2 ** 53 + 1, "a"), (None, None), (3, "c")}
