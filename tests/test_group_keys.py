"""Group keys of any kind come back as they were from every group operator: NULL, numbers beyond 2^53, text."""

import pytest
from pyspark.sql import functions as F

from fipsight.operators import profile, rollup, series, stats
from fipsight.operators.forecast import fit_ar, predict_ar
from fipsight.operators.moments import pattern_moments
from fipsight.operators.select import knn_cv_accuracy, select_features, select_features_knn

BIG = 2 ** 53
KEYS = {"long": [None, BIG + 1, BIG + 2, -BIG - 1], "string": [None, "", "01001", "1001"], "double": [None, 0.1, 2.5, -1.0]}


def rows(spark, kind):
    """Forty rows for each key."""
    data = [(k, i, float(i % 7), float(i * i % 11), float(i % 5) + 0.1 * i, i % 2) for k in KEYS[kind] for i in range(40)]
    return spark.createDataFrame(data, f"g {kind}, id long, a double, b double, y double, label int")


def selected(df):
    return df.select("g").distinct().withColumn("features", F.array(F.lit("a"))).withColumn("feature", F.lit("a"))


def forecast(df):
    windows = series.sliding_windows(df, "g", "id", "y", width=4, n_inputs=2)
    return predict_ar(windows, fit_ar(windows, "g", n_inputs=2, horizon=2), "g").where("pred IS NOT NULL")


OPERATORS = {
    "standardize": lambda df: stats.group_standardize(df, "g", ["a"]),
    "correlation": lambda df: stats.group_correlation(df, "g", "a", "y").where("n > 0"),
    "gram": lambda df: stats.gram_table(df, "g", ["a", "b"], "y"),
    "ols": lambda df: stats.ols(pattern_moments(df, "g", ["a", "b"], "y"), "g", ["a", "b"], "y").where("status = 'ok'"),
    "ols_allowed": lambda df: stats.ols(pattern_moments(df, "g", ["a", "b"], "y"), "g", ["a", "b"], "y",
                                        allowed=selected(df)).where("feature = 'a'"),
    "select": lambda df: select_features(pattern_moments(df, "g", ["a", "b"], "y"), "g", ["a", "b"], "y", k=1).where("status = 'ok'"),
    "select_knn": lambda df: select_features_knn(df, "g", "id", "label", ["a", "b"], k=1).where("status = 'ok'"),
    "select_knn_tiled": lambda df: select_features_knn(df, "g", "id", "label", ["a", "b"], k=1, block_rows=16).where("status = 'ok'"),
    "knn": lambda df: knn_cv_accuracy(df, "g", "id", "label", ["a", "b"], k=3),
    "knn_tiled": lambda df: knn_cv_accuracy(df, "g", "id", "label", ["a", "b"], k=3, block_rows=16),
    "histogram": lambda df: profile.feature_histogram(df, "g", ["a", "b"]),
    "screen": lambda df: profile.frequency_screen(profile.feature_histogram(df, "g", ["a", "b"]), "g"),
    "keep_selected": lambda df: profile.keep_selected(profile.unpivot_features(df, "g", ["a", "b"]), selected(df), "g"),
    "selected_histograms": lambda df: profile.selected_histograms(selected(df).drop("feature"), profile.feature_histogram(df, "g", ["a"]), "g"),
    "paired": lambda df: rollup.paired_series(df.select("g", "id", "a"), df.select("g", "id", "y"), "g", "id", "a", "y").where("y IS NOT NULL"),
    "grid": lambda df: rollup.dense_period_grid(df.select("g", "id", "a"), "g", "id", "a", 1, 3),
    "forecast": forecast,
}


@pytest.fixture(scope="module")
def frames(spark):
    return {kind: rows(spark, kind).cache() for kind in KEYS}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("kind", KEYS)
def test_keys_come_back(frames, name, kind):
    got = OPERATORS[name](frames[kind])
    assert got.schema["g"].dataType == frames[kind].schema["g"].dataType
    assert {r.g for r in got.select("g").distinct().collect()} == set(KEYS[kind])


def test_a_join_without_keys_is_refused(frames):
    with pytest.raises(ValueError):
        rollup.join_groups(frames["long"], frames["long"], [])
