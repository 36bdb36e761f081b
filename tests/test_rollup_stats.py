"""Rollups, joins, statistics against hand-worked fixtures and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.functions import fips_from_float_text, fips_from_parts, safe_double
from fipsight.operators import rollup, stats
from fipsight.operators.moments import pattern_moments
from fipsight.operators.project import exclude_label, min_length


def test_pollution_daily_mean_fixture(spark):
    rows = [("1", "73", "8-HR", "1980-01-03", "70"), ("01", "073", "8-HR", "1980-01-03", "83"),
            ("1", "73", "1-HR", "1980-01-03", "5"), ("1", "73", "8-HR", "1980-01-10", "16"),
            ("1", "73", "8-HR", "1980-01-10", ""), ("6", "37", "8-HR", "1980-01-03", "abc")]
    df = spark.createDataFrame(rows, "state string, county string, dur string, dt string, aqi string")
    clean = df.where(F.col("dur") == "8-HR").select(
        fips_from_parts("state", "county").alias("fips"), F.to_date("dt").alias("ts"),
        safe_double("aqi").alias("aqi"))
    got = sorted((r.fips, str(r.dt), r.mean) for r in
                 rollup.daily_mean(clean, "fips", "ts", "aqi").collect())
    assert got == [("01073", "1980-01-03", 76.5), ("01073", "1980-01-10", 16.0)]


def test_mortality_clean_and_sum_fixture(spark):
    rows = [("United States", "", "508", "3", "1980", 9.0), ("Alabama", "1.0", "508", "3", "1980", 4.0),
            ("Autauga", "1001.0", "508", "3", "1980", 2.5), ("Autauga", "1001.0", "509", "3", "1980", 1.5),
            ("Autauga", "1001.0", "508", "1", "1980", 7.0), ("Utah County", "49049", "508", "3", "1980", 0.0)]
    df = spark.createDataFrame(rows, "name string, fips string, cause string, sex string, year string, rate double")
    m = exclude_label(df, "name", "United States").withColumn("fips", fips_from_float_text("fips"))
    m = min_length(m, "fips", 2)
    assert sorted(r.fips for r in m.collect()) == ["01001", "01001", "01001", "49049"]
    s = rollup.sum_by_key_period(m, "fips", F.col("year").cast("int"), "rate",
                                 out="rate", where=F.col("sex") == "3")
    assert sorted(tuple(r) for r in s.collect()) == [("01001", 1980, 4.0), ("49049", 1980, 0.0)]


def test_yearly_mean_is_mean_of_daily_means(spark):
    df = spark.createDataFrame([("a", "1990-01-01", 10.0), ("a", "1990-01-01", 20.0),
                                ("a", "1990-06-01", 30.0), ("a", "2021-01-01", 5.0)],
                               "fips string, dt string, aqi double")
    d = rollup.daily_mean(df, "fips", "dt", "aqi")
    y = rollup.yearly_mean(d, "fips", start=1980, end=2019).collect()
    assert [(r.year, r.mean, r.n_days) for r in y] == [(1990, 22.5, 2)]


def test_dense_grid(spark):
    y = spark.createDataFrame([("a", 1981, 1.0), ("a", 1983, 3.0), ("b", 1979, 9.0)],
                              "fips string, year int, aqi double")
    g = rollup.dense_period_grid(y, "fips", "year", "aqi", 1980, 1983)
    got = sorted(tuple(r) for r in g.collect())
    assert got == [("a", 1980, None), ("a", 1981, 1.0), ("a", 1982, None), ("a", 1983, 3.0),
                   ("b", 1980, None), ("b", 1981, None), ("b", 1982, None), ("b", 1983, None)]


def test_correlation_golden_and_guards(spark):
    expo = spark.createDataFrame([("c", 1, 1.0), ("c", 2, 2.0), ("c", 3, 4.0), ("c", 4, float("nan")),
                                  ("z", 1, 1.0)], "fips string, year int, aqi double")
    outc = spark.createDataFrame([("c", 1, 2.0), ("c", 2, 3.0), ("c", 3, 4.0), ("c", 4, 5.0),
                                  ("z", 7, 1.0)], "fips string, year int, rate double")
    pairs = rollup.paired_series(expo, outc, "fips", "year", "aqi", "rate")
    r3 = {r.fips: r for r in stats.group_correlation(pairs, "fips", "aqi", "rate", period="year",
                                                      min_n=3, with_series=True).collect()}
    assert abs(r3["c"].beta - 0.9819805060619659) < 1e-12
    assert r3["c"].years == [1, 2, 3] and r3["c"].aqis == [1.0, 2.0, 4.0]
    # county with both sides but no common year: kept, n = 0, empty series
    assert r3["z"].n == 0 and r3["z"].beta is None and r3["z"].years == []
    r10 = {r.fips: r.beta for r in stats.group_correlation(pairs, "fips", "aqi", "rate").collect()}
    assert r10["c"] is None


def test_correlation_zero_rate_and_constant(spark):
    rows = [("a", i, float(i), 0.0 if i == 3 else float(i * i)) for i in range(1, 13)]
    rows += [("k", i, 5.0, float(i)) for i in range(1, 13)]
    df = spark.createDataFrame(rows, "fips string, year int, x double, y double")
    r = {x.fips: x for x in stats.group_correlation(df, "fips", "x", "y").collect()}
    assert r["a"].n == 11
    xs = np.array([i for i in range(1, 13) if i != 3], float)
    assert abs(r["a"].beta - np.corrcoef(xs, xs ** 2)[0, 1]) < 1e-12
    assert r["k"].beta is None          # constant exposure: NULL, not an error
    r2 = {x.fips: x.n for x in stats.group_correlation(df, "fips", "x", "y",
                                                        zero_is_missing=False).collect()}
    assert r2["a"] == 12


def test_correlation_invariant_under_scaling_and_partitioning(spark):
    rng = np.random.default_rng(1)
    rows = [("g%d" % (i % 3), i, float(rng.normal()), float(rng.normal())) for i in range(300)]
    df = spark.createDataFrame(rows, "fips string, year int, x double, y double")
    base = {r.fips: r.beta for r in stats.group_correlation(df, "fips", "x", "y").collect()}
    scaled = df.withColumn("x", F.col("x") * 7 + 3).repartition(7)
    again = {r.fips: r.beta for r in stats.group_correlation(scaled, "fips", "x", "y").collect()}
    for k in base:
        assert -1 <= base[k] <= 1 and abs(base[k] - again[k]) < 1e-12


PERSONS = [("10022008", 15, 1, 0), ("10022008", 16, 2, 3), ("10022008", 99, 9, 4),
           ("10022012", 60, 1, 3), ("10022012", 998, 2, 17), ("10022012", 30, 2, 99)]


@pytest.mark.parametrize("rule,want", [
    ("intended", {"10022008": [1, 1, 0, 0, 1, 1, 1, 2], "10022012": [0, 0, 1, 2, 1, 2, 1, 1]}),
    ("literal", {"10022008": [1, 1, 0, 0, 1, 1, 2, 1], "10022012": [0, 0, 1, 2, 1, 2, 3, 0]}),
])
def test_person_rollup_fixture(spark, rule, want):
    df = spark.createDataFrame(PERSONS, "id string, age int, sex int, ru int")
    got = {r.id: list(r)[1:] for r in
           rollup.person_rollup(df, "id", "age", "sex", "ru", restraint_rule=rule).collect()}
    assert got == want
    for counts in got.values():      # age and sex counts never exceed the persons
        assert sum(counts[:4]) <= 3 and sum(counts[4:6]) <= 3


def test_standardize(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 2.0)], "g string, x double")
    got = sorted((r.g, r.x_z) for r in stats.group_standardize(df, "g", ["x"]).collect())
    assert got == [("a", -1.0), ("a", 1.0), ("b", None), ("b", None)]


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(7)
    n, k = 60, 4
    X = rng.normal(size=(n, k)) + np.array([0, 1, 2, 3])
    y = X @ np.array([0.5, -1.0, 0.2, 0.0]) + rng.normal(size=n)
    rows = [("c", *map(float, X[i]), float(y[i])) for i in range(n)]
    rows += [("d", float(i), 1.0, float(i % 3), float(i % 5), float(i * 2 % 7)) for i in range(40)]
    cols = ["f1", "f2", "f3", "f4"]
    df = spark.createDataFrame(rows, "g string, f1 double, f2 double, f3 double, f4 double, y double")
    res = stats.ols(pattern_moments(df, "g", cols, "y"), "g", cols, "y").collect()
    got = {r.feature: r for r in res if r.g == "c"}
    Xn = (X - X.mean(0)) / X.std(0)
    yn = (y - y.mean()) / y.std()
    b = np.linalg.pinv(Xn.T @ Xn) @ Xn.T @ yn
    dof = n - (1 + k)
    rss = np.sum((yn - Xn @ b) ** 2)
    se = np.sqrt(rss / dof / np.sum(Xn ** 2))
    for i, c in enumerate(cols):
        assert abs(got[c].beta - b[i]) < 1e-9
        assert abs(got[c].t - b[i] / se) < 1e-6
        assert got[c].dof == dof and 0 <= got[c].p_value <= 0.5
    # constant feature f2 in group d is reported, not fed to the solver
    d = {r.feature: r for r in res if r.g == "d"}
    assert d["f2"].status == "constant" and d["f1"].status == "ok"


def test_ols_per_coefficient_se_two_sided(spark):
    rng = np.random.default_rng(17)
    n = 50
    X = rng.normal(size=(n, 2))
    y = 0.7 * X[:, 0] + rng.normal(size=n)
    df = spark.createDataFrame([("g", float(a), float(b), float(c)) for (a, b), c in zip(X, y)],
                               "k string, a double, b double, y double")
    res = {r.feature: r for r in stats.ols(pattern_moments(df, "k", ["a", "b"], "y"), "k",
                                           ["a", "b"], "y", se="coef", tails=2).collect()}
    Xn = (X - X.mean(0)) / X.std(0)
    yn = (y - y.mean()) / y.std()
    inv = np.linalg.inv(Xn.T @ Xn)
    b = inv @ Xn.T @ yn
    s2 = np.sum((yn - Xn @ b) ** 2) / (n - 3)
    for i, f in enumerate(["a", "b"]):
        assert abs(res[f].t - b[i] / np.sqrt(s2 * inv[i, i])) < 1e-8
        assert 0 <= res[f].p_value <= 1
    assert res["a"].p_value < 1e-4
