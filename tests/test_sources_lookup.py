"""Readers, writers, JSON flattening, yearly merges, lookups and feature preparation."""

import os

from pyspark.sql import functions as F

from fipsight.operators.lookup import fips_lookup
from fipsight.operators.project import feature_prep, select_keep
from fipsight.sources.files import read_csv, with_path_token, write_single_csv, write_table
from fipsight.sources.json_flat import flatten_json
from fipsight.sources.tuple_text import parse_tuple_text
from fipsight.sources.yearly import column_census, column_presence, merge_years, read_years


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_dropped_in_every_file(spark, tmp_dir):
    _write(f"{tmp_dir}/m/a.csv", "FIPS,rate\n1001.0,2.5\n")
    _write(f"{tmp_dir}/m/b.csv", "FIPS,rate\n49049,0\n")
    df = read_csv(spark, f"{tmp_dir}/m/*.csv", "fips string, rate double")
    assert sorted(tuple(r) for r in df.collect()) == [("1001.0", 2.5), ("49049", 0.0)]


def test_csv_corrupt_and_path_token(spark, tmp_dir):
    _write(f"{tmp_dir}/p/daily_44201_1990.csv", "fips,aqi\n01073,abc\n01073,16\n")
    df = read_csv(spark, f"{tmp_dir}/p/", "fips string, aqi double", corrupt_col="_bad")
    df = with_path_token(df, "pollutant", r"daily_([^_/]+)_")
    rows = sorted(((r.fips, r.aqi, r.pollutant, r._bad is not None) for r in df.collect()),
                  key=lambda t: t[3])
    assert rows == [("01073", 16.0, "44201", False), ("01073", None, "44201", True)]


def test_latin1_csv(spark, tmp_dir):
    p = f"{tmp_dir}/l/x.csv"
    os.makedirs(os.path.dirname(p))
    with open(p, "wb") as f:
        f.write("name\nDo\xf1a Ana\n".encode("latin-1"))
    df = read_csv(spark, p, "name string", encoding="ISO-8859-1")
    assert df.first().name == "Doña Ana"


def test_tuple_text(spark):
    df = spark.createDataFrame([("('20001', '7', '2', '1999', '0.251')",),
                                ("('1001.0', '508', '3', '1980', 'x')",)], "value string")
    got = parse_tuple_text(df, [("fips", "string"), ("cause", "int"), ("sex", "int"),
                                ("year", "int"), ("rate", "double")], cut_at_dot=["fips"]).collect()
    assert tuple(got[0]) == ("20001", 7, 2, 1999, 0.251)
    assert tuple(got[1]) == ("1001", 508, 3, 1980, None)


def test_json_flatten_fixture(spark):
    doc = '{"value":[{"a":1,"b":{"c":"x"},"d":[{"e":2},{"e":3}],"f":[7,8],"g":[]}]}'
    df = spark.createDataFrame([(doc,)], "j string")
    out = flatten_json(df, "j", record_path="$.value")
    assert sorted(out.columns) == ["@a", "@b@c", "@d0@e", "@d1@e", "@f0", "@f1"]
    r = out.first()
    assert (r["@a"], r["@b@c"], r["@d0@e"], r["@d1@e"], r["@f0"], r["@f1"]) == (1, "x", 2, 3, 7, 8)


def test_json_flatten_union_of_keys(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"b": {"c": [1, 2, 3]}}')], "id int, j string")
    out = flatten_json(df, "j", keep=["id"])
    assert sorted(out.columns) == ["@a", "@b@c0", "@b@c1", "@b@c2", "id"]
    got = {r.id: (r["@a"], r["@b@c2"]) for r in out.collect()}
    assert got == {1: (1, None), 2: (None, 3)}


def test_years_merge_census_and_report(spark, tmp_dir):
    _write(f"{tmp_dir}/y/2000.csv", "ST_CASE,YEAR,HOUR,ARR_MIN\n1,2000,5,10\n")
    _write(f"{tmp_dir}/y/2001.csv", "ST_CASE,YEAR,HOUR\n2,2001,6\n")

    def reader(s, p):
        return s.read.option("header", True).option("inferSchema", False).csv(p)

    frames, report = read_years(spark, lambda y: f"{tmp_dir}/y/{y}.csv", [2000, 2001, 2002], reader)
    assert sorted(frames) == [2000, 2001]
    rep = {r.year: r.status for r in report.collect()}
    assert rep[2000] == "ok" and rep[2002].startswith("skipped")
    merged = merge_years(frames, keep=["ST_CASE", "HOUR", "ARR_MIN", "ARR_HOUR"])
    rows = sorted(tuple(r) for r in merged.collect())
    assert rows == [("1", "5", "10", None, 2000), ("2", "6", None, None, 2001)]
    census = {r.column_name: r.n_files for r in column_census(spark, frames).collect()}
    assert census == {"ST_CASE": 2, "YEAR": 2, "HOUR": 2, "ARR_MIN": 1}
    pres = {r.column_name: r.n_files for r in column_presence(merged).collect()}
    assert pres == {"ST_CASE": 2, "HOUR": 2, "ARR_MIN": 1, "ARR_HOUR": 0}


def test_keep_list_adds_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = select_keep(df, ["b", "zz"])
    assert out.columns == ["b", "zz"] and tuple(out.first()) == (2, None)


LOOKUP = [(1000, "ALABAMA", "NA", 0), (1001, "Autauga County", "AL", 1),
          (1129, "Washington County", "AL", 2), (5143, "Washington County", "AR", 3)]


def test_fips_lookup_fixture(spark):
    lk = spark.createDataFrame(LOOKUP, "fips int, name string, state string, line int")
    acc = spark.createDataFrame([("Washington", "AL"), ("Washington", "AR"), ("Autauga", "AL"),
                                 ("Nowhere", "AL"), ("ALABAMA", "NA")], "county string, st string")
    by_state = sorted(tuple(r) for r in fips_lookup(acc, lk, "county", "st").collect())
    assert ("Washington", "AL", 1129) in by_state and ("Washington", "AR", 5143) in by_state
    assert ("Nowhere", "AL", None) in by_state
    name_only = {(r.county, r.st): r.fips for r in
                 fips_lookup(acc, lk, "county", None, on_name_only=True, order_col="line").collect()}
    assert name_only[("Washington", "AL")] == 5143          # later row wins
    twice = lk.unionByName(lk.where("name = 'Washington County'").withColumn("line", F.col("line") + 10))
    assert fips_lookup(acc, twice, "county", "st").count() == 5  # repeated rows do not multiply


def test_feature_prep(spark):
    df = spark.createDataFrame([("A1", "2", "2016-03-01 00:00:00", "2016-03-01 01:07:12", "R",
                                 "False", "True", "keep-me", "drop-me")],
                               "id string, sev string, s string, e string, side string, f1 string, "
                               "f2 string, other string, gone string")
    out = feature_prep(df, "s", "e", "side", flags=["f1", "f2"], numeric={"sev": "int"},
                       keep=["id", "other", "gone"], drop=["gone"], ts_format="yyyy-MM-dd HH:mm:ss")
    r = out.first().asDict()
    assert r == {"id": "A1", "other": "keep-me", "year": 2016, "month": 3, "day_of_year": 60,
                 "duration_h": 1.12, "side_flag": 1, "sev": 2, "f1": 0, "f2": 1}


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("a", "44201", 1.0), ("b", "42401", 2.0)], "fips string, pol string, v double")
    write_table(df, f"{tmp_dir}/out", partition_by=["pol"])
    back = spark.read.parquet(f"{tmp_dir}/out").where(F.col("pol") == "44201")
    assert [r.fips for r in back.collect()] == ["a"]
    write_single_csv(df, f"{tmp_dir}/csv")
    parts = [p for p in os.listdir(f"{tmp_dir}/csv") if p.endswith(".csv")]
    assert len(parts) == 1


def test_feature_histogram_equals_long_form(spark):
    from fipsight.operators.profile import feature_histogram, unpivot_features, value_histogram
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, None), ("a", 2, 2.0), ("b", 3, 4.0)],
                               "g string, x int, y double")
    one = sorted((tuple(r) for r in feature_histogram(df, "g", ["x", "y"]).collect()), key=repr)
    two = sorted((tuple(r) for r in value_histogram(unpivot_features(df, "g", ["x", "y"]), "g")
                  .select("g", "feature", "value", "cnt", "n_rows").collect()), key=repr)
    assert one == two and ("a", "y", None, 1, 3) in one


def test_series_text_and_histogram_map(spark, tmp_dir):
    from fipsight.operators.profile import histogram_map
    from fipsight.sources.files import read_series_text
    _write(f"{tmp_dir}/s/part-0", "01073,1980-01-03,76.5\n01073,1980-01-10,16.0\n")
    df = read_series_text(spark, f"{tmp_dir}/s")
    assert sorted((r.fips, str(r.dt), r.aqi) for r in df.collect()) == [
        ("01073", "1980-01-03", 76.5), ("01073", "1980-01-10", 16.0)]
    h = spark.createDataFrame([("c", "f", 1.0, 3), ("c", "f", 2.0, 1)],
                              "g string, feature string, value double, cnt long")
    assert histogram_map(h, "g").first().histogram == {1.0: 3, 2.0: 1}


def test_numeric_where(spark):
    from fipsight.operators.project import numeric_where
    df = spark.createDataFrame([("8-HR", "70"), ("8-HR", ""), ("8-HR", "abc"), ("1-HR", "5"),
                                ("8-HR", "inf")], "d string, v string")
    assert [r.v for r in numeric_where(df, F.col("d") == "8-HR", "v").collect()] == ["70"]


def test_json_flatten_odd_keys_and_nested_lists(spark):
    doc = """{"a b": 1, "it's": "x", "m": [[1, 2], [3]], "n": {"k": null}}"""
    out = flatten_json(spark.createDataFrame([(doc,)], "j string"), "j")
    r = out.first().asDict()
    assert r["@a b"] == 1 and r["@it's"] == "x"
    assert r["@m0"] == "[1,2]" and r["@m1"] == "[3]"
