"""Edge cases of SURVEY §5: empty inputs give empty results (no errors), NULL keys stay
groups of their own, 9 vs 10 periods around the correlation guard."""

from pyspark.sql import functions as F

from fipsight.operators import rollup, series, stats
from fipsight.operators.moments import pattern_moments
from fipsight.operators.select import knn_cv_accuracy, select_features


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "fips string, dt string, aqi double")
    assert rollup.daily_mean(e, "fips", "dt", "aqi").count() == 0
    p = spark.createDataFrame([], "fips string, year int, x double, y double")
    assert stats.group_correlation(p, "fips", "x", "y").count() == 0
    g = pattern_moments(p, "fips", ["x"], "y")
    assert g.count() == 0 and stats.ols(g, "fips", ["x"], "y").count() == 0
    assert select_features(g, "fips", ["x"], "y", k=1).count() == 0
    w = series.sliding_windows(spark.createDataFrame([], "k string, t int, v double"), "k", "t", "v")
    assert w.count() == 0
    pts = spark.createDataFrame([], "g int, id long, label long, a double")
    assert knn_cv_accuracy(pts, "g", "id", "label", ["a"]).count() == 0


def test_null_key_is_its_own_group(spark):
    df = spark.createDataFrame([(None, "1990-01-01", 1.0), (None, "1990-01-01", 3.0),
                                ("a", "1990-01-01", 5.0)], "fips string, dt string, aqi double")
    got = {r.fips: r.mean for r in rollup.daily_mean(df, "fips", "dt", "aqi").collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_correlation_guard_nine_vs_ten(spark):
    rows = [("nine", i, float(i), float(i * 2 + (i % 3))) for i in range(1, 10)]
    rows += [("ten", i, float(i), float(i * 2 + (i % 3))) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "fips string, year int, x double, y double")
    got = {r.fips: (r.n, r.beta) for r in stats.group_correlation(df, "fips", "x", "y").collect()}
    assert got["nine"] == (9, None)
    assert got["ten"][0] == 10 and got["ten"][1] is not None
