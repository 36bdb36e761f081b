"""Missing values, odd types, groups that must neither vanish nor be invented."""

import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fipsight.functions import composite_id, response_minutes
from fipsight.operators.lookup import fips_lookup
from fipsight.operators.moments import pattern_moments
from fipsight.operators.profile import feature_histogram, value_histogram
from fipsight.operators.rollup import join_groups, paired_series, person_rollup
from fipsight.operators.select import (incomplete_points, knn_cv_accuracy, select_features,
                                       select_features_knn)
from fipsight.operators.stats import gram_table, group_standardize, ols
from fipsight.plans import chains, cli
from fipsight.sources.files import read_csv
from fipsight.sources.json_flat import flatten_json, flatten_json_long


def _reg(spark, groups, n=40, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for g in groups:
        x = rng.normal(size=(n, 3))
        y = x @ [1.0, -2.0, 0.5] + rng.normal(size=n) * 0.1
        rows += [(g, *map(float, r), float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "g string, a double, b double, c double, y double")


def test_group_outside_the_selection_is_not_fitted(spark):
    df = _reg(spark, ["p", "q"])
    gram = pattern_moments(df, "g", ["a", "b", "c"], "y")
    allowed = spark.createDataFrame([("p", "a"), ("p", "b")], "g string, feature string")
    rows = {(r.g, r.feature): r.status for r in ols(gram, "g", ["a", "b", "c"], "y", allowed=allowed).collect()}
    assert rows == {("p", "a"): "ok", ("p", "b"): "ok", ("q", None): "not_selected"}
    sel = {r.g: (r.features, r.status) for r in
           select_features(gram, "g", ["a", "b", "c"], "y", k=1, allowed=allowed).collect()}
    assert sel == {"p": (["b"], "ok"), "q": ([], "too_few_features")}


def _knn_rows(n=120, seed=3):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n) * 2 - 1
    x = rng.normal(size=(n, 2)) + label[:, None] * 0.7
    return [(i, int(l), float(a), float(b)) for i, (l, (a, b)) in enumerate(zip(label, x))]


def test_knn_paths_agree_with_negative_labels_null_groups_and_missing_features(spark):
    rows = [(g, *r) for g in ("a", None) for r in _knn_rows()]
    rows += [("a", 1000 + i, 1, None, 0.0) for i in range(7)] + [(None, 2000, 1, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "g string, id long, label int, x double, z double")
    small, big = ({(r.g, r.fold): (r.n_test, r.n_correct) for r in
                   knn_cv_accuracy(df, "g", "id", "label", ["x", "z"], k=3, block_rows=b).collect()} for b in (1024, 30))
    assert small == big and {g for g, _ in small} == {"a", None}
    assert sum(n for n, _ in small.values()) == 240
    left = {r.g: (r.n_rows, r.n_incomplete) for r in incomplete_points(df, "g", "id", "label", ["x", "z"]).collect()}
    assert left == {"a": (127, 7), None: (121, 1)}


def test_knn_accepts_text_ids_and_any_labels(spark):
    base = spark.createDataFrame([("a", *r) for r in _knn_rows()], "g string, id long, label int, x double, z double")
    want = sorted(map(tuple, knn_cv_accuracy(base, "g", "id", "label", ["x", "z"], k=3).collect()))
    text = base.withColumn("id", F.format_string("k%06d", "id")).withColumn(
        "label", F.when(F.col("label") < 0, 0.2).otherwise(0.7))
    assert sorted(map(tuple, knn_cv_accuracy(text, "g", "id", "label", ["x", "z"], k=3).collect())) == want
    words = base.withColumn("label", F.when(F.col("label") < 0, "no").otherwise("yes"))
    assert sorted(map(tuple, knn_cv_accuracy(words, "g", "id", "label", ["x", "z"], k=3).collect())) == want
    sel = select_features_knn(text, "g", "id", "label", ["x", "z"], k=1).first()
    assert sel.status == "ok" and len(sel.features) == 1 and sel.score is not None


def test_null_group_keys_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 1.0), ("a", 5.0)], "g string, x double")
    assert group_standardize(df, "g", ["x"]).where("x_z IS NOT NULL").count() == 4
    assert feature_histogram(df, "g", ["x"]).count() == 4
    assert value_histogram(df.withColumnRenamed("x", "value").withColumn("feature", F.lit("f")), "g").count() == 4
    assert join_groups(df, df.groupBy("g").agg(F.count("*").alias("n")), "g").where("n = 2").count() == 4


def test_drifting_nan_and_far_columns_do_not_empty_a_regression(spark):
    rng = np.random.default_rng(5)
    t = rng.normal(size=60)
    rows = [("k", float(t[i] + rng.normal() * 0.1), None if i < 40 else float(rng.normal()),
             float(2e7 + t[i] + rng.normal() * 0.05), float("nan") if i == 0 else float(rng.normal()), float(t[i]))
            for i in range(60)]
    df = spark.createDataFrame(rows, "g string, a double, drift double, far double, one_nan double, y double")
    feats = ["a", "drift", "far", "one_nan"]
    gram = gram_table(df, "g", feats, "y")
    g = {(r.f1, r.f2): (r.gram, r.n) for r in gram.collect()}
    assert all(n == 60 for _, n in g.values())
    far = [r[3] for r in rows]
    assert g["far", "y"][0] == pytest.approx(60 * np.corrcoef(np.array(far) - 2e7, t)[0, 1], rel=1e-6)
    assert {r.status for r in ols(pattern_moments(df, "g", feats, "y"), "g", feats, "y").collect()} == {"ok"}


def test_perfect_fit_has_p_zero(spark):
    df = spark.createDataFrame([("g", float(i), float(2 * i)) for i in range(20)], "g string, x double, y double")
    r = ols(pattern_moments(df, "g", ["x"], "y"), "g", ["x"], "y").first()
    assert r.status == "ok" and r.beta == pytest.approx(1.0) and r.p_value == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("build", [gram_table, pattern_moments])
def test_gram_plan_of_sixty_features_builds_quickly(spark, build):
    feats = [f"f{i}" for i in range(60)]
    df = spark.createDataFrame([], ", ".join(["g string", "y double", *[f"{f} double" for f in feats]]))
    build(df, "g", feats[:3], "y")
    t = time.perf_counter()
    build(df, "g", feats, "y")
    assert time.perf_counter() - t < 10  # under 3 s on an idle machine


def test_codes_written_as_floats(spark):
    df = spark.createDataFrame([(1002.0, 2008.0, 10.0, 30.0, 9.0, 50.0)], "c double, y double, ah double, am double, ch double, cm double")
    r = df.select(composite_id("c", "y").alias("id"), response_minutes("ah", "am", "ch", "cm").alias("m")).first()
    assert r.id == "10022008" and r.m == 40
    text = spark.createDataFrame([("12.0", "2008"), ("x", "2008")], "c string, y string")
    assert [r.id for r in text.select(composite_id("c", "y").alias("id")).collect()] == ["122008", None]
    p = spark.createDataFrame([("1002008", 15.0, 1.0, 0.0), ("1002008", 70.0, 2.0, 3.0)],
                              "id string, age double, sex double, rest double")
    r = person_rollup(p, "id", "age", "sex", "rest").first()
    assert (r.age_lt16, r.age_60p, r.sex1, r.sex2, r.restraint_unused, r.restraint_used) == (1, 1, 1, 1, 1, 1)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("rate,fips\n2.5,1001\nbad,1003\n")
    rows = read_csv(spark, str(tmp_path / "a.csv"), "fips string, rate double, absent int", corrupt_col="_bad").collect()
    assert sorted((r.fips, r.rate, r.absent, r._bad) for r in rows if r.rate) == [("1001", 2.5, None, None)]
    assert [r._bad for r in rows if r.rate is None] == ["bad,1003"]
    (tmp_path / "b.csv").write_text("fips,rate\n1005,3\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "*.csv"), "fips string, rate double").collect()


def test_lookup_never_multiplies_rows(spark):
    lk = spark.createDataFrame([(1001, "A County", "AL", 1), (1003, "A County", "AL", 2)], "fips int, name string, state string, line int")
    df = spark.createDataFrame([("A", "AL")], "c string, s string")
    assert [r.fips for r in fips_lookup(df, lk, "c", "s", order_col="line").collect()] == [1003]


def test_paired_series_keeps_keys_without_common_period(spark):
    x = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 3.0), ("c", 1, 4.0)], "k string, p int, x double")
    y = spark.createDataFrame([("a", 1, 9.0), ("b", 2, 8.0)], "k string, p int, y double")
    assert sorted(map(tuple, paired_series(x, y, "k", "p", "x", "y").collect())) == [("a", 1, 2.0, 9.0), ("b", 1, 3.0, None)]


def test_short_series_keeps_its_county(spark):
    rows = [("long", datetime(2000, 1, 1) + timedelta(days=i), float(i % 7)) for i in range(80)]
    rows += [("short", datetime(2000, 1, 1) + timedelta(days=i), 1.0) for i in range(10)]
    daily = spark.createDataFrame(rows, "fips string, dt timestamp, mean double")
    got = {r.fips: r.status for r in chains.aqi_forecast(daily, n_test=20).errors.collect()}
    assert got == {"long": "ok", "short": "too_few_windows"}


@pytest.mark.parametrize("knn", [False, True])
def test_accident_command(spark, tmp_path, knn):
    rng = np.random.default_rng(9)
    n = 60
    sev = rng.integers(0, 2, n)
    acc = pd.DataFrame({"ID": [f"{i}2008" for i in range(n)], "LOCATION": ["1001"] * 50 + ["1003"] * 10, "SEVERITY": sev,
                        "F1": sev * 2 + rng.integers(0, 2, n), "F2": rng.integers(0, 3, n), "F3": rng.integers(0, 2, n)})
    acc["F3"] = acc["F3"].astype(object)
    acc.loc[0, "F3"] = "Unknown"
    per = pd.DataFrame({"ID": acc.ID, "AGE": rng.integers(5, 80, n), "SEX": rng.integers(1, 3, n), "REST_USE": 3})
    acc.to_csv(tmp_path / "a.csv", index=False)
    per.to_csv(tmp_path / "p.csv", index=False)
    out = str(tmp_path / "out")
    cli.main(["accidents", "--persons", str(tmp_path / "p.csv"), "--accidents", str(tmp_path / "a.csv"), "--features",
              "F1,F2,F3", "--k", "2", "--exclude", "age_lt16", "--out", out, *(["--knn"] if knn else [])])
    read = {t: spark.read.parquet(f"{out}/{t}") for t in ("selection", "histograms", "ols", "person_counts")}
    chosen = {r.LOCATION: set(r.features) for r in read["selection"].collect()}
    assert len(chosen["1001"]) == 2 and "age_lt16" not in chosen["1001"]
    for t in ("histograms", "ols"):
        got = {r.feature for r in read[t].where("LOCATION = '1001'").collect()}
        assert got == chosen["1001"]
    short = read["ols"].where("LOCATION = '1003'").collect()
    assert chosen["1003"] or {r.status for r in short} == {"not_selected"}


def test_json_members_of_mixed_kinds(spark):
    docs = ['{"b":"x","a":1,"n":[1,2]}', '{"b":3,"a":{"c":2},"n":[]}', 'not json', '{"n":[[1,2],{"z":null}]}', None]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, j string")
    got = {r.id: r.asDict() for r in flatten_json(df, "j", keep=["id"]).collect()}
    assert [got[i]["@b"] for i in range(5)] == ["x", "3", None, None, None]
    assert (got[0]["@a"], got[0]["@a@c"], got[1]["@a"], got[1]["@a@c"]) == (1, None, None, 2)
    assert (got[0]["@n0"], got[0]["@n1"], got[3]["@n0"], got[3]["@n1@z"]) == ("1", 2, "[1,2]", None)
    rows = sorted((r.id, r.name, r.value) for r in flatten_json_long(df, "j", keep=["id"]).collect())
    assert rows == [(0, "@a", "1"), (0, "@b", "x"), (0, "@n0", "1"), (0, "@n1", "2"), (1, "@a@c", "2"), (1, "@b", "3"),
                    (3, "@n0", "[1,2]"), (3, "@n1@z", None)]


def test_pca_keeps_rows_that_lack_a_value(spark):
    from fipsight.operators.decompose import pca_fit, pca_scores
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(2 * a + b)) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    whole = spark.createDataFrame(rows, "id int, a double, b double")
    holes = whole.unionByName(spark.createDataFrame([(100, None, 1.0), (101, float("nan"), 1.0)], whole.schema))
    f, g = pca_fit(whole, ["a", "b"], 1, keep=["id"]), pca_fit(holes, ["a", "b"], 1, keep=["id"])
    assert g.n == 40 and g.components == pytest.approx(f.components)
    got = {r.id: r.scores for r in pca_scores(g, keep=["id"]).collect()}
    assert len(got) == 42 and got[100] is None and got[101] is None and got[0] is not None
