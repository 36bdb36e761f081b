"""Accident chains on yearly files, the older extract, component analysis, and cell types."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.functions.casts import cell_typed, try_typed, type_report
from fipsight.plans import cli
from fipsight.plans.accidents import component_analysis, prepare_accidents, prepare_point_accidents

YEARS = (2000, 2001, 2003)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    """Accident, auxiliary and person files of three years; columns drift, some codes are no numbers."""
    top = tmp_path_factory.mktemp("fars")
    for y in YEARS:
        d = top / f"FARS{y}NationalCSV"
        d.mkdir()
        head = ["ST_CASE", "STATE", "HOUR", "MINUTE", "ARR_HOUR", "ARR_MIN"] + (["YEAR"] if y != 2003 else []) + (["NEW"] if y == 2001 else [])
        rows = [{"ST_CASE": f"{1000 + i}" + (".0" if i % 2 else ""), "STATE": "1", "HOUR": "23", "MINUTE": str(50 + i), "ARR_HOUR": "0",
                 "ARR_MIN": "x" if i == 3 else str(5 + i), "YEAR": str(y), "NEW": "n"} for i in range(5)]
        rows[4]["ST_CASE"] = "??" if y == 2000 else rows[4]["ST_CASE"]
        (d / "ACCIDENT.CSV").write_text("\n".join([",".join(head), *(",".join(r[c] for c in head) for r in rows)]) + "\n")
        (d / "ACC_AUX.CSV").write_text("YEAR,A_RU,ST_CASE\n" + "".join(f"{y},{i % 3},{1000 + i}\n" for i in range(4)))
        (d / "PERSON.CSV").write_bytes(("ST_CASE,AGE,N\xe9\n" + "".join(f"{1000 + i},{20 + i},\xe9\n" for i in range(4) for _ in range(2))).encode("latin-1"))
    return top


def test_preparation_from_yearly_files(spark, root):
    got = prepare_accidents(spark, f"{root}/FARS*/ACCIDENT.CSV", range(2000, 2004), f"{root}/*/ACC_AUX.CSV", f"{root}/*/PERSON.CSV",
                            encoding="ISO-8859-1")
    acc = {(r.file_year, r.ST_CASE.split(".")[0]): r for r in got.accidents.collect()}
    assert len(acc) == 15 and acc[2000, "??"].ID is None and acc[2000, "1001"].ID == "10012000"
    assert acc[2003, "1002"].ID == "10022003" and acc[2003, "1002"].YEAR is None and acc[2003, "1002"].A_RU == "2"
    assert acc[2001, "1002"].response_minutes == 24 * 60 + 7 - (23 * 60 + 52) and acc[2001, "1003"].response_minutes is None
    assert acc[2001, "1000"].NEW == "n" and acc[2000, "1000"].NEW is None and acc[2001, "1004"].A_RU is None
    persons = got.persons.groupBy("ID").count().collect()
    assert len(persons) == 12 and all(r["count"] == 2 for r in persons) and "Né" in got.persons.columns
    report = {(r.table, r.year): r.status for r in got.report.collect()}
    assert report["accident", 2002] == "missing" and report["person", 2003] == "ok"
    census = {(r.table, r.column_name): r.n_files for r in got.census.collect()}
    assert census["accident", "YEAR"] == 2 and census["accident", "NEW"] == 1 and census["auxiliary", "A_RU"] == 3
    bad = {(r.table, r.file_year, r.column_name): (r.n_bad, r.example) for r in got.bad.collect()}
    assert bad == {("accident", 2000, "ST_CASE"): (1, "??")} | {("accident", y, "ARR_MIN"): (1, "x") for y in YEARS}


def test_preparation_keep_lists_and_command(spark, root, tmp_path):
    got = prepare_accidents(spark, f"{root}/FARS*/ACCIDENT.CSV", YEARS, keep=["STATE", "none"])
    assert got.persons is None and {"STATE", "none", "ID", "response_minutes"} <= set(got.accidents.columns) and "NEW" not in got.accidents.columns
    cli.main(["prepare", "--accidents", f"{root}/FARS*/ACCIDENT.CSV", "--persons", f"{root}/*/PERSON.CSV", "--first", "2000", "--last", "2003",
              "--encoding", "ISO-8859-1", "--out", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/accidents").count() == 15 and spark.read.parquet(f"{tmp_path}/report").count() == 8


def test_older_extract(spark):
    raw = spark.createDataFrame([("a", "2016-02-29 10:00:00", "2016-02-29 11:30:00", "R", "Bibb", "AL", "False", "True", "3"),
                                 ("b", "bad", "2016-03-01 00:00:00", "L", "Nowhere", "AL", "True", "x", "?")],
                                "id string, Start_Time string, End_Time string, Side string, County string, State string, Bump string, Stop string, Severity string")
    lookup = spark.createDataFrame([(1007, "Bibb County", "AL"), (13021, "Bibb County", "GA"), (13, "Georgia", "GA")], "fips int, name string, state string")
    by_name = {r.id: r for r in prepare_point_accidents(raw, lookup, flags=["Bump", "Stop"], numeric={"Severity": "int"}, keep=["id"]).collect()}
    assert (by_name["a"].fips, by_name["a"].year, by_name["a"].day_of_year, by_name["a"].duration_h, by_name["a"].Side_flag,
            by_name["a"].Bump, by_name["a"].Stop, by_name["a"].Severity) == (13021, 2016, 59, 1.5, 1, 0, 1, 3)
    assert by_name["b"].fips is None and by_name["b"].year is None and by_name["b"].Severity is None
    both = prepare_point_accidents(raw, lookup, state="State", keep=["id"])
    assert {r.id: r.fips for r in both.collect()} == {"a": 1007, "b": None}


def test_component_analysis_and_command(spark, tmp_path):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4))
    rows = [(str(i), *(str(v) for v in x), int(i % 3), 1.0) for i, x in enumerate(X)] + [("odd", "x", "1", "1", "1", 2, 1.0)]
    df = spark.createDataFrame(rows, "ID string, a string, b string, c string, d string, SEVERITY int, LOCATION double")
    found = component_analysis(df, ["a", "b", "c", "d", "SEVERITY", "LOCATION"], "SEVERITY", exclude=["LOCATION"], keep=["ID"])
    Z = (X - X.mean(0)) / X.std(0)
    values, vectors = np.linalg.eigh(np.cov(Z, rowvar=False))
    want = np.sqrt(((vectors * np.sqrt(values)) ** 2).sum(1))
    got = {r.feature: r.significance for r in found.significance.collect()}
    np.testing.assert_allclose([got[c] for c in "abcd"], want, rtol=1e-8)
    assert [r.cumulative for r in found.variance.orderBy("component").collect()][-1] == pytest.approx(1.0)
    scores = {r.ID: r for r in found.scores.collect()}
    assert len(scores) == 121 and scores["odd"].scores is None and scores["odd"].SEVERITY == 2 and len(scores["7"].scores) == 4
    df.write.parquet(f"{tmp_path}/in")
    cli.main(["components", "--accidents", f"{tmp_path}/in", "--features", "a,b,c,d", "--k", "2", "--out", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/loadings").count() == 8


def test_cell_types_and_type_report(spark):
    df = spark.createDataFrame([("1", "1.5", "a", None, " ", "1-0-3"), ("2", "7", "3", None, "", "2"), (None, "1e3", "", None, None, "")],
                               "i string, d string, t string, n string, b string, id string")
    report = {r.column_name: r for r in type_report(df).collect()}
    assert {c: r.kind for c, r in report.items()} == {"i": "bigint", "d": "double", "t": "string", "n": "string", "b": "string", "id": "string"}
    assert (report["t"].n_integer, report["t"].n_text, report["t"].example, report["d"].example) == (1, 1, "a", "1.5")
    typed = dict(try_typed(df, keep_text=["id"]).dtypes)
    assert (typed["i"], typed["d"], typed["t"], typed["id"]) == ("bigint", "double", "string", "string")
    cells = cell_typed(df, ["t", "d", "n"]).select(*[F.schema_of_variant(c).alias(c) for c in ("t", "d", "n")]).collect()
    assert [tuple(r) for r in cells] == [("STRING", "DOUBLE", None), ("BIGINT", "BIGINT", None), ("STRING", "DOUBLE", None)]
    plan = cell_typed(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
