"""Presence-pattern moments and the fits on them against numpy on complete cases."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.operators.moments import Moments, map_moment_groups, pattern_moments
from fipsight.operators.select import floating_search, select_features
from fipsight.operators.stats import ols
from pyspark.sql import types as T

NAMES = ["a", "b", "c", "d"]
SCHEMA = "g string, a double, b double, c double, d double, y double"


def rows_of(seed, n, missing, shift=0.0):
    """n rows of four correlated features and a target; each cell is missing with its column's share."""
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 4)) + shift
    y = X @ rng.normal(size=4) + rng.normal(size=n) * 2 + shift
    data = np.column_stack([X, y])
    data[rng.random(data.shape) < np.array(missing)] = np.nan
    return data


def frame(spark, groups):
    rows = [(g, *[None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)]) for g, data in groups.items() for r in data]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def complete(data, at):
    return data[~np.isnan(data[:, at]).any(1)][:, at]


def fit(data, at):
    """(n, beta, t, R²) of the z-scored least-squares fit on the complete cases, by numpy."""
    rows = complete(data, [*at, 4])
    z = (rows - rows.mean(0)) / rows.std(0)
    X, y = z[:, :-1], z[:, -1]
    b = np.linalg.pinv(X) @ y
    rss = ((y - X @ b) ** 2).sum()
    dof = len(rows) - 1 - len(at)
    return len(rows), b, b / np.sqrt(rss / dof / (X ** 2).sum()) if dof > 0 else None, 1 - rss / len(rows)


SHARES = [[0.0] * 5, [0.0, 0.5, 0.0, 0.0, 0.0], [0.3, 0.2, 0.4, 0.1, 0.1], [0.0, 0.95, 0.0, 0.6, 0.0], [0.2, 0.9, 0.2, 0.2, 0.3]]


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_every_subset_equals_its_complete_cases(spark, shift):
    data = {f"g{i}": rows_of(i, 400, share, shift) for i, share in enumerate(SHARES)}
    table = pattern_moments(frame(spark, data), "g", NAMES, "y")
    subsets = [list(s) for r in (1, 2, 3, 4) for s in itertools.combinations(range(4), r)]
    fields = [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("n", T.LongType()),
              T.StructField("mean", T.ArrayType(T.DoubleType())), T.StructField("cov", T.ArrayType(T.DoubleType()))]

    def all_subsets(group: Moments, allow):
        out = []
        for at in subsets:
            n, mean, cov = group.complete([*[NAMES[i] for i in at], "y"])
            out.append((at, n, mean.tolist(), cov.ravel().tolist()))
        return out

    got = map_moment_groups(table, "g", all_subsets, fields).collect()
    assert len(got) == len(data) * len(subsets)
    for r in got:
        rows = complete(data[r.g], [*r["at"], 4])
        assert r.n == len(rows)
        if len(rows):
            np.testing.assert_allclose(r["mean"], rows.mean(0), rtol=1e-12)
            np.testing.assert_allclose(np.reshape(r["cov"], (len(r["at"]) + 1,) * 2), np.cov(rows.T, bias=True), rtol=1e-6, atol=1e-9)


def test_regression_and_selection_on_complete_cases(spark):
    data = {f"g{i}": rows_of(10 + i, 300, share) for i, share in enumerate(SHARES)}
    table = pattern_moments(frame(spark, data), "g", NAMES, "y")
    for r in ols(table, "g", NAMES, "y").collect():
        n, b, t, _ = fit(data[r.g], [0, 1, 2, 3])
        k = NAMES.index(r.feature)
        assert (r.dof, r.status) == (n - 5, "ok" if n > 5 else "too_few_rows" if n else "no_complete_rows")
        assert r.beta == pytest.approx(b[k], rel=1e-6, abs=1e-9)
        if n > 5:
            assert r.t == pytest.approx(t[k], rel=1e-6) and 0 <= r.p_value <= 0.5
    for r in select_features(table, "g", NAMES, "y", k=2).collect():
        def score(s, own=data[r.g]):
            n, *_, r2 = fit(own, sorted(s))
            return r2 if n >= 10 else -np.inf
        chosen, best = floating_search(score, 4, 2)
        assert (r.status, r.features) == ("ok", [NAMES[i] for i in chosen])
        assert r.r2 == pytest.approx(best, abs=1e-9) and r.r2 <= 1 and r.n == fit(data[r.g], chosen)[0]


def test_few_present_values_give_few_degrees_of_freedom(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(1000, 5))
    data[:, 1] = data[:, 4] * 0.5 + rng.normal(size=1000)
    data[10:, 1] = np.nan
    got = {r.feature: r for r in ols(pattern_moments(frame(spark, {"g": data}), "g", ["b"], "y"), "g", ["b"], "y").collect()}
    n, b, t, _ = fit(data, [1])
    assert got["b"].dof == 8 and got["b"].t == pytest.approx(t[0]) and got["b"].p_value > 1e-6


def test_statuses_and_odd_values(spark):
    inf = float("inf")
    rows = [("one", 1.0, None, None, 1.0, 2.0)]
    rows += [("none", 1.0, 2.0, 3.0, 4.0, None)] * 3
    rows += [("flat", float(i), 5.0, None, float(i % 3), 1.5) for i in range(20)]
    rows += [("apart", float(i), float(i % 4) if i < 10 else None, float(i % 5) if i >= 10 else None, 0.1, float(i * i)) for i in range(20)]
    rows += [("inf", float(i), float(i % 4), inf if i == 3 else float(i % 5), float("nan") if i == 4 else 2.0, float(i) if i else inf) for i in range(20)]
    rows += [(None, float(i), float(i % 4), float(i % 7), float(i % 3), float(i % 5)) for i in range(20)]
    table = pattern_moments(spark.createDataFrame(rows, SCHEMA), "g", NAMES, "y")
    got = {(r.g, r.feature): r for r in ols(table, "g", NAMES, "y").collect()}
    status = {k: r.status for k, r in got.items()}
    assert {status[g, f] for g in ("one", "none", "flat") for f in NAMES} == {"constant_target"}
    assert status["apart", "a"] == status["apart", "b"] == status["apart", "c"] == "no_complete_rows" and status["apart", "d"] == "constant"
    assert status["inf", "a"] == "ok" and got["inf", "a"].dof == 18 - 4 and status["inf", "d"] == "constant"
    assert {status[None, f] for f in NAMES} == {"ok"}
    assert all(r.p_value is None or 0 <= r.p_value <= 0.5 for r in got.values())
    sel = {r.g: r.status for r in select_features(table, "g", NAMES, "y", k=2).collect()}
    assert sel == {"one": "too_few_rows", "none": "too_few_rows", "flat": "too_few_features", "apart": "ok", "inf": "ok", None: "ok"}
    assert ols(table.where("false"), "g", NAMES, "y").count() == 0


def test_a_column_that_never_varies_among_the_complete_cases(spark):
    rows = [("g", float(i), 7.0 if i < 15 else float(i), float(i % 4) if i < 15 else None, 0.0, float(i % 6)) for i in range(40)]
    got = {r.feature: r.status for r in ols(pattern_moments(spark.createDataFrame(rows, SCHEMA), "g", NAMES, "y"), "g", ["a", "b", "c"], "y").collect()}
    assert got == {"a": "ok", "b": "constant", "c": "ok"}


def test_text_numbers_and_extra_column_names(spark):
    df = spark.createDataFrame([("g", str(i), "x" if i == 2 else str(i % 3), float(i)) for i in range(12)],
                               "present string, n string, mean string, y double").withColumn("co", F.lit(1))
    got = ols(pattern_moments(df.withColumnRenamed("present", "grp"), "grp", ["n", "mean"], "y"), "grp", ["n", "mean"], "y").collect()
    assert [r.dof for r in got] == [11 - 3, 11 - 3]
