"""Command line for the three analyses (``spark-submit -m``-style use, parameters by name).

    python -m fipsight.plans.cli pollution --epa 'hdfs:///epa/daily_*.csv' \
        --condition '8-HR RUN AVG' --mortality hdfs:///ghdx/mortality.csv --out hdfs:///out/poll
    python -m fipsight.plans.cli accidents --persons P --accidents A --features F1,F2,... \
        --out O [--knn] [--neighbors 2] [--k 10]
    python -m fipsight.plans.cli prepare --accidents 'D/FARS*/ACCIDENT.CSV' --persons 'D/FARS*/PERSON.CSV' \
        --auxiliary 'D/FARS*/ACC_AUX.CSV' --first 2000 --last 2018 --out O
    python -m fipsight.plans.cli components --accidents A --features F1,F2,... --target SEVERITY --out O
    python -m fipsight.plans.cli forecast --daily hdfs:///out/poll/daily --out O

The session comes from the environment (``spark-submit`` / ``getOrCreate``); the master is never
set here. Outputs are Parquet directories, one per result table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fipsight.plans import chains
from fipsight.plans.accidents import component_analysis, prepare_accidents
from fipsight.sources.files import write_table


def _pollution(spark, a):
    write_table(chains.read_pollution(spark, a.epa, a.condition), f"{a.out}/readings")
    daily = spark.read.parquet(f"{a.out}/readings")  # the raw files are read once
    mort = chains.clean_mortality(spark.read.option("header", True).csv(a.mortality))
    res = chains.pollution_mortality(daily, mort, sex_code=a.sex, min_years=a.min_years)
    write_table(res.daily, f"{a.out}/daily", partition_by=["pollutant"])
    write_table(res.dense, f"{a.out}/yearly", partition_by=["pollutant"])
    write_table(res.regression, f"{a.out}/regression", partition_by=["pollutant"])
    write_table(res.overall, f"{a.out}/overall", partition_by=["pollutant"])


def _accidents(spark, a):
    persons = spark.read.option("header", True).csv(a.persons)
    accidents = spark.read.option("header", True).csv(a.accidents)
    feats = [f for f in a.features.split(",") if f]
    def keep(df, name):
        write_table(df, f"{a.out}/{name}")
        return spark.read.parquet(f"{a.out}/{name}")

    res = chains.accident_severity(persons, accidents, feats, k=a.k, criterion="knn" if a.knn else "r2", n_neighbors=a.neighbors,
                                   exclude=[e for e in a.exclude.split(",") if e], keep=keep)
    write_table(res.histograms, f"{a.out}/histograms")
    write_table(res.ols, f"{a.out}/ols")


def _prepare(spark, a):
    got = prepare_accidents(spark, a.accidents, range(a.first, a.last + 1), a.auxiliary, a.persons, encoding=a.encoding)
    for name, df in (("accidents", got.accidents), ("persons", got.persons), ("census", got.census), ("report", got.report),
                     ("bad_values", got.bad)):
        if df is not None:
            write_table(df, f"{a.out}/{name}")


def _components(spark, a):
    found = component_analysis(spark.read.parquet(a.accidents), a.features.split(","), a.target, a.k,
                               [e for e in a.exclude.split(",") if e])
    for name in ("scores", "variance", "loadings", "significance"):
        write_table(getattr(found, name), f"{a.out}/{name}")


def _forecast(spark, a):
    daily = spark.read.parquet(a.daily)
    res = chains.aqi_forecast(daily, key="fips", day="dt", value="mean", n_test=a.n_test)
    write_table(res.predictions, f"{a.out}/predictions")
    write_table(res.errors, f"{a.out}/errors")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="fipsight")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("pollution")
    s.add_argument("--epa", required=True, nargs="+")
    s.add_argument("--condition", required=True)
    s.add_argument("--mortality", required=True)
    s.add_argument("--sex", type=int, default=3)
    s.add_argument("--min-years", type=int, default=10)
    s.add_argument("--out", required=True)
    s = sub.add_parser("accidents")
    s.add_argument("--persons", required=True)
    s.add_argument("--accidents", required=True)
    s.add_argument("--features", required=True)
    s.add_argument("--exclude", default="")
    s.add_argument("--k", type=int, default=10)
    s.add_argument("--knn", action="store_true")
    s.add_argument("--neighbors", type=int, default=2)
    s.add_argument("--out", required=True)
    s = sub.add_parser("prepare")
    s.add_argument("--accidents", required=True, nargs="+")
    s.add_argument("--auxiliary", nargs="+")
    s.add_argument("--persons", nargs="+")
    s.add_argument("--first", type=int, required=True)
    s.add_argument("--last", type=int, required=True)
    s.add_argument("--encoding", default="UTF-8")
    s.add_argument("--out", required=True)
    s = sub.add_parser("components")
    s.add_argument("--accidents", required=True)
    s.add_argument("--features", required=True)
    s.add_argument("--target", default="SEVERITY")
    s.add_argument("--exclude", default="")
    s.add_argument("--k", type=int)
    s.add_argument("--out", required=True)
    s = sub.add_parser("forecast")
    s.add_argument("--daily", required=True)
    s.add_argument("--n-test", type=int, default=3000)
    s.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"fipsight-{a.cmd}").getOrCreate()
    {"pollution": _pollution, "accidents": _accidents, "prepare": _prepare, "components": _components, "forecast": _forecast}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
