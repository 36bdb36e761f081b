"""End-to-end chains on small files in the real layouts."""

import os

import numpy as np
from pyspark.sql import functions as F

from fipsight.plans.chains import (accident_severity, aqi_forecast, clean_mortality,
                                   pollution_mortality, read_pollution)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_pollution_mortality_chain(spark, tmp_dir):
    rng = np.random.default_rng(4)
    head = "State Code,County Code,Site Num,Parameter Code,Sample Duration,Date Local,AQI\n"
    rows44, rows42 = [], []
    for y in range(1990, 2002):
        for day in ("01-05", "06-10"):
            a = 20 + (y - 1990) * 2 + rng.normal()
            rows44.append(f"1,73,1,44201,8-HR RUN AVG,{y}-{day},{a:.1f}")
            rows44.append(f"1,73,2,44201,1 HOUR,{y}-{day},999")
            rows42.append(f"6,37,1,42401,8-HR RUN AVG,{y}-{day},{50 - (y - 1990) + rng.normal():.1f}")
    rows44.append("1,73,1,44201,8-HR RUN AVG,2021-01-01,5")      # outside 1980..2019
    _write(f"{tmp_dir}/epa/daily_44201_1990.csv", head + "\n".join(rows44) + "\n")
    _write(f"{tmp_dir}/epa/daily_42401_1990.csv", head + "\n".join(rows42) + "\n")
    mort = ["location_name,FIPS,cause_id,sex_id,year_id,mx", "United States,,508,3,1990,9"]
    for y in range(1990, 2002):
        mort.append(f"Autauga,1073.0,508,3,{y},{10 + (y - 1990) * 0.5}")
        mort.append(f"Autauga,1073.0,509,3,{y},1.0")
        mort.append(f"LA,6037.0,508,3,{y},{3 + (y % 3)}")
    _write(f"{tmp_dir}/mort/m.csv", "\n".join(mort) + "\n")
    daily = read_pollution(spark, f"{tmp_dir}/epa/*.csv", "8-HR RUN AVG")
    mraw = spark.read.option("header", True).csv(f"{tmp_dir}/mort/m.csv")
    res = pollution_mortality(daily, clean_mortality(mraw))
    reg = {(r.fips, r.pollutant): r for r in res.regression.collect()}
    assert set(reg) == {("01073", "44201"), ("06037", "42401")}
    a = reg[("01073", "44201")]
    assert a.n == 12 and a.beta > 0.9 and a.years == list(range(1990, 2002))
    flat = res.overall.where(F.col("fips") == "01073").collect()
    assert len(flat) == 12 and {r.beta for r in flat} == {a.beta}
    assert all(r.county_id == 1073 for r in flat)


def test_accident_chain(spark):
    rng = np.random.default_rng(8)
    acc_rows, person_rows = [], []
    for i in range(109):
        loc = "1-0-3" if i < 100 else "1-0-5"          # 100 and 9 accidents
        f = rng.integers(0, 4, size=6).astype(float)
        sev = float(f[0] + 2 * f[2] + rng.integers(0, 2))
        case = f"{1000 + i}2008"
        acc_rows.append((case, loc, sev, *f.tolist(), 7.0))
        for p in range(int(rng.integers(1, 4))):
            person_rows.append((case, int(rng.integers(1, 90)), int(rng.integers(1, 3)),
                                int(rng.choice([0, 3, 17, 20]))))
    cols = ["f1", "f2", "f3", "f4", "f5", "f6", "const"]
    accidents = spark.createDataFrame(acc_rows, "ID string, LOCATION string, SEVERITY double, "
                                      + ", ".join(f"{c} double" for c in cols))
    persons = spark.createDataFrame(person_rows, "ID string, AGE int, SEX int, REST_USE int")
    res = accident_severity(persons, accidents, cols, k=3)
    sel = {r.LOCATION: r for r in res.selection.collect()}
    assert sel["1-0-3"].status == "ok" and {"f1", "f3"} <= set(sel["1-0-3"].features)
    assert sel["1-0-5"].status == "too_few_rows" and sel["1-0-5"].features == []
    ols = res.ols.where("LOCATION = '1-0-3'").collect()
    assert {r.feature for r in ols} == set(sel["1-0-3"].features)
    best = {r.feature: r.p_value for r in ols}
    assert best["f3"] < 1e-6
    hist = res.histograms.where("LOCATION = '1-0-3'").collect()
    assert {r.feature for r in hist} == set(sel["1-0-3"].features)
    assert all(r.n_rows == 100 for r in hist)


def test_forecast_chain(spark):
    vals = [10 + 5 * np.sin(i / 3.0) for i in range(200)]
    df = spark.createDataFrame([("01073", i, float(v)) for i, v in enumerate(vals)],
                               "fips string, dt int, mean double")
    res = aqi_forecast(df, n_test=50)
    assert res.windows.count() == 185 and res.windows.where("is_test").count() == 50
    assert res.predictions.count() == 50 + 4
    err = res.errors.first()
    assert err.n == 250 and err.mae < 1e-6


def test_cli_pollution_and_forecast(spark, tmp_dir):
    from fipsight.plans.cli import main
    head = "State Code,County Code,Site Num,Parameter Code,Sample Duration,Date Local,AQI\n"
    lines = [f"1,73,1,44201,8-HR,{1990 + i // 40}-{1 + (i // 2) % 12:02d}-{1 + i % 2:02d},{20 + i % 7}"
             for i in range(480)]
    _write(f"{tmp_dir}/epa/daily_44201_1990.csv", head + "\n".join(lines) + "\n")
    mort = ["location_name,FIPS,cause_id,sex_id,year_id,mx"] + \
        [f"Autauga,1073.0,508,3,{y},{5 + y % 4}" for y in range(1990, 2002)]
    _write(f"{tmp_dir}/mort.csv", "\n".join(mort) + "\n")
    main(["pollution", "--epa", f"{tmp_dir}/epa/*.csv", "--condition", "8-HR",
          "--mortality", f"{tmp_dir}/mort.csv", "--out", f"{tmp_dir}/out"])
    reg = spark.read.parquet(f"{tmp_dir}/out/regression").collect()
    assert len(reg) == 1 and reg[0].n == 12 and str(reg[0].pollutant) == "44201"
    main(["forecast", "--daily", f"{tmp_dir}/out/daily", "--n-test", "20", "--out", f"{tmp_dir}/fc"])
    assert spark.read.parquet(f"{tmp_dir}/fc/errors").count() == 1
