"""Files with differing headers in one scan."""

import pytest
from pyspark.sql import functions as F

from fipsight.sources.drift import header_census, header_map, read_drifting, year_report

COLUMNS = ["ST_CASE", "STATE", "HOUR", "LATITUDE", "DRUNK_DR", "a,b"]


@pytest.fixture(scope="module")
def yearly(tmp_path_factory):
    """Nineteen yearly files: order of columns, missing and extra columns, quotes, blanks and byte order marks vary."""
    root = tmp_path_factory.mktemp("yearly files")
    rows = {}
    for y in range(2000, 2019):
        if y == 2007:
            continue
        names = COLUMNS[:]
        if y % 2:
            names.reverse()
        if y % 3 == 0:
            names.remove("HOUR")
        if y >= 2015:
            names.append(f"NEW{y % 2}")
        folder = root / f"{y} data"
        folder.mkdir()
        text = ",".join(f'"{n}"' if "," in n or y % 5 == 0 else f" {n} " for n in names) + "\n"
        if y == 2010:
            text = ""
        else:
            for i in range(5):
                row = {n: f"{n[:2]}{y}_{i}" for n in names}
                row["a,b"] = "x,y" if i else ""
                rows[y, i] = row
                text += ",".join(f'"{row[n]}"' if "," in row[n] else row[n] for n in names) + "\n"
        (folder / "accident.csv").write_text(("﻿" if y == 2003 else "") + text, encoding="utf-8")
    (root / "2004 data" / "_SUCCESS").write_text("")
    return root, rows


def test_every_row_lands_under_its_names(spark, yearly):
    root, want = yearly
    headers = header_map(spark, f"{root}/*data")
    got = read_drifting(spark, headers)
    assert set(got.columns) == {*COLUMNS, "NEW0", "NEW1", "file_path"}
    rows = {}
    for r in got.collect():
        year, i = int(r.file_path.split("/")[-2][:4]), int((r["ST_CASE"]).split("_")[1])
        rows[year, i] = {c: r[c] for c in got.columns if c != "file_path"}
    assert rows == {k: {c: v.get(c) or None for c in rows[k]} for k, v in want.items()}


def test_one_scan_and_a_keep_list(spark, yearly):
    root, want = yearly
    got = read_drifting(spark, header_map(spark, [f"{root}/*/accident.csv", f"{root}/nothing"]), keep=["HOUR", "none", "STATE"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan csv") == 1 and "Exchange hashpartitioning" not in plan
    assert got.columns == ["HOUR", "none", "STATE", "file_path"] and got.count() == len(want)
    assert got.where("none IS NOT NULL").count() == 0
    assert got.where("HOUR IS NULL").count() == sum("HOUR" not in v for v in want.values())


def test_census_and_report_from_the_same_map(spark, yearly):
    root, want = yearly
    headers = header_map(spark, str(root))
    census = {r.column_name: r.n_files for r in header_census(spark, headers).collect()}
    per_year = {y: v for (y, _), v in want.items()}
    assert census == {c: sum(c in v for v in per_year.values()) for c in [*COLUMNS, "NEW0", "NEW1"]}
    report = {r.year: r.status for r in year_report(spark, headers, range(2000, 2020), r"/(\d{4})[^/]*/accident").collect()}
    assert {y for y, s in report.items() if s == "missing"} == {2007, 2019} and report[2010] == "empty"


def test_large_files_are_split_and_another_separator(spark, tmp_path):
    for y, names in ((1, ["k", "v"]), (2, ["v", "w", "k"])):
        with open(tmp_path / f"f{y}.txt", "w", encoding="latin-1") as f:
            f.write(";".join(names) + "\r\n")
            for i in range(30_000):
                f.write(";".join({"k": f"{y}-{i}", "v": f"é{i}", "w": "w"}[n] for n in names) + "\r\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = read_drifting(spark, header_map(spark, f"{tmp_path}/f*.txt", ";", "ISO-8859-1"))
        assert got.rdd.getNumPartitions() > 4
        r = got.agg(F.count("*"), F.count_distinct("k"), F.count_if(F.col("v") == F.concat(F.lit("é"), F.split("k", "-")[1])),
                    F.count_if(F.col("w").isNotNull())).first()
        assert tuple(r) == (60_000, 60_000, 60_000, 30_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_file_at_all(spark, tmp_path):
    headers = header_map(spark, f"{tmp_path}/*.csv")
    assert headers.files == [] and read_drifting(spark, headers, keep=["a"]).count() == 0
    assert header_census(spark, headers).count() == 0


def test_a_year_in_several_parts_counts_once(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "id % 4 AS file_year", "string(id) AS x").repartition(5)
    df.write.partitionBy("file_year").option("header", True).csv(f"{tmp_path}/t")
    census = {r.column_name: r.n_files for r in header_census(spark, header_map(spark, f"{tmp_path}/t"), r"file_year=(\d+)/").collect()}
    assert census == {"id": 4, "x": 4}


def test_a_pollutant_after_another_keeps_both(spark, tmp_path):
    from fipsight.sources.files import write_table

    def run(pollutant, value):
        write_table(spark.createDataFrame([("01001", value, pollutant)], "fips string, beta double, pollutant string"),
                    f"{tmp_path}/reg", partition_by=["pollutant"])

    run("44201", 0.1), run("42401", 0.2), run("44201", 0.3)
    assert {(r.pollutant, r.beta) for r in spark.read.parquet(f"{tmp_path}/reg").collect()} == {(44201, 0.3), (42401, 0.2)}
    write_table(spark.range(3).toDF("a"), f"{tmp_path}/whole")
    write_table(spark.range(2).toDF("a"), f"{tmp_path}/whole")
    assert spark.read.parquet(f"{tmp_path}/whole").count() == 2
