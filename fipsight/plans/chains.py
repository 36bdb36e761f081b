"""The three end-to-end analyses on their real input files, each one Spark plan per output.

Column names default to the public layouts of the source files; every name is a parameter.

1. ``pollution_mortality``: daily monitor files -> AQI per (county, day) -> per (county, year)
   -> joined with yearly death rates -> standardized slope (correlation) per county and
   pollutant -> one flat row per (county, pollutant, year).
2. ``accident_severity``: person files rolled up per accident -> joined to accidents ->
   near-constant screen -> floating forward selection per county -> OLS with p-values on the
   selected features.
3. ``aqi_forecast``: daily county series -> 15-reading windows -> autoregressive fit on the
   training windows -> predictions of the holdout windows, overlap-resolved, with errors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fipsight.functions import fips_from_float_text, fips_from_parts, safe_double
from fipsight.functions.casts import int_code
from fipsight.operators import rollup, series, stats
from fipsight.operators.forecast import fit_ar, predict_ar
from fipsight.operators.frequent import chosen_histograms, feature_screen
from fipsight.operators.moments import pattern_moments
from fipsight.operators.project import exclude_label, min_length
from fipsight.operators.select import select_features, select_features_knn
from fipsight.sources.files import read_csv, with_path_token

# Fixed values of the source layouts (public file formats).
EPA_DAILY_COLUMNS = {"state": "State Code", "county": "County Code",
                     "duration": "Sample Duration", "date": "Date Local", "aqi": "AQI"}
YEAR_RANGE = (1980, 2019)


def clean_pollution(raw: DataFrame, condition: str, cols: dict | None = None,
                    pollutant: str | None = None) -> DataFrame:
    """Monitor rows of one sample duration with a numeric AQI, keyed by 5-digit county."""
    c = {**EPA_DAILY_COLUMNS, **(cols or {})}
    aqi = safe_double(c["aqi"])
    out = raw.where((F.col(c["duration"]) == condition) & aqi.isNotNull()).select(
        fips_from_parts(c["state"], c["county"]).alias("fips"),
        F.col(c["date"]).try_cast("date").alias("day"), aqi.alias("aqi"),
        *([F.col("pollutant")] if "pollutant" in raw.columns else
          [F.lit(pollutant).alias("pollutant")] if pollutant else []))
    return out


def clean_mortality(raw: DataFrame, location: str = "location_name", fips: str = "FIPS",
                    cause: str = "cause_id", sex: str = "sex_id", year: str = "year_id",
                    rate: str = "mx") -> DataFrame:
    """Counties only (national row and 1-2 digit state ids dropped), typed columns."""
    m = exclude_label(raw, location, "United States")
    m = m.select(fips_from_float_text(fips).alias("fips"),
                 int_code(cause).alias("cause"), int_code(sex).alias("sex"), int_code(year).alias("year"),
                 safe_double(F.col(rate).cast("string")).alias("rate"))
    return min_length(m, "fips", 2)


@dataclass
class PollutionResult:
    daily: DataFrame        # fips, pollutant, dt, mean, n_readings
    yearly: DataFrame       # fips, pollutant, year, aqi
    dense: DataFrame        # fips, pollutant, year (every year of the range), aqi or NULL
    regression: DataFrame   # fips, pollutant, n, beta, years, aqis, rates
    overall: DataFrame      # county_id, fips, pollutant, year, aqi, rate, beta


def pollution_mortality(daily_clean: DataFrame, mortality: DataFrame, sex_code: int = 3,
                        min_years: int = 10, zero_is_missing: bool = True,
                        years: tuple[int, int] = YEAR_RANGE) -> PollutionResult:
    """Chain 1 from cleaned monitor rows (``clean_pollution``) and ``clean_mortality`` rows."""
    keys = ["fips", "pollutant"] if "pollutant" in daily_clean.columns else ["fips"]
    daily = rollup.daily_mean(daily_clean, keys, "day", "aqi")
    yearly = rollup.yearly_mean(daily, keys, value="mean", out="aqi", start=years[0],
                                end=years[1])
    deaths = rollup.sum_by_key_period(mortality, "fips", F.col("year"), "rate", out="rate",
                                      where=F.col("sex") == sex_code)
    pairs = rollup.paired_series(yearly, deaths, "fips", "year", "aqi", "rate")
    reg = stats.group_correlation(pairs, keys, "aqi", "rate", period="year", min_n=min_years,
                                  zero_is_missing=zero_is_missing, with_series=True)
    flat = rollup.explode_series(
        reg.select(F.col("fips").try_cast("int").alias("county_id"), "fips",
                   *(["pollutant"] if "pollutant" in keys else []), "beta",
                   "years", "aqis", "rates"),
        ["county_id", "fips", *(["pollutant"] if "pollutant" in keys else []), "beta"],
        ["years", "aqis", "rates"], ["year", "aqi", "rate"])
    dense = rollup.dense_period_grid(yearly, keys, "year", "aqi", years[0], years[1])
    return PollutionResult(daily, yearly, dense, reg, flat)


def read_pollution(spark: SparkSession, paths: str | Sequence[str], condition: str,
                   pollutant_pattern: str = r"daily_([^_/]+)_") -> DataFrame:
    """Daily monitor CSVs (any number of pollutants and years); the pollutant code is taken
    from each file's name."""
    raw = read_csv(spark, paths, header=True)
    raw = with_path_token(raw, "pollutant", pollutant_pattern)
    return clean_pollution(raw, condition)


@dataclass
class AccidentResult:
    counts: DataFrame       # id + eight person counts
    accidents: DataFrame    # accident rows with counts
    screen: DataFrame       # (county, feature, n_frequent)
    selection: DataFrame    # (county, features, r2 or score, n, status)
    histograms: DataFrame   # (county, feature, value, cnt, n_rows) of the selected features
    ols: DataFrame          # (county, feature, beta, t, dof, status, p_value)


def accident_severity(persons: DataFrame, accidents: DataFrame, features: Sequence[str],
                      person_id: str = "ID", age: str = "AGE", sex: str = "SEX",
                      restraint: str = "REST_USE", accident_id: str = "ID",
                      county: str = "LOCATION", target: str = "SEVERITY", k: int = 10,
                      exclude: Sequence[str] = (), restraint_rule: str = "intended",
                      tails: int = 1, criterion: str = "r2", n_neighbors: int = 2,
                      keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> AccidentResult:
    """Chain 2. ``features`` are numeric accident columns; the eight person counts are added
    to them. Selection uses the R² criterion on complete cases, or with ``criterion='knn'`` the
    cross-validated k-NN rule; histograms and the regression use that selection's features of each
    county only. Text that is no number is missing. ``keep(frame, name)`` may write a stage's table
    and read it back, so that later stages do not compute it again."""
    if criterion not in ("r2", "knn"):
        raise ValueError("criterion must be 'r2' or 'knn'")
    counts = rollup.person_rollup(persons, person_id, age, sex, restraint,
                                  restraint_rule=restraint_rule)
    if person_id != accident_id:
        counts = counts.withColumnRenamed(person_id, accident_id)
    counts = keep(counts, "person_counts")
    acc = rollup.attach_person_counts(accidents, counts, accident_id)
    feats = [f for f in list(features) + rollup.PERSON_COUNT_COLUMNS if f not in set(exclude)]
    numeric = keep(acc.select(county, accident_id, F.col(target).try_cast("double").alias(target),
                              *[F.col(f).try_cast("double").alias(f) for f in feats]), "features")
    screen = keep(feature_screen(numeric, county, feats), "screen")
    moments = keep(pattern_moments(numeric, county, feats, target), "moments")
    if criterion == "knn":
        sel = select_features_knn(numeric, county, accident_id, target, feats, k=k,
                                  n_neighbors=n_neighbors, allowed=screen)
    else:
        sel = select_features(moments, county, feats, target, k=k, allowed=screen)
    sel = keep(sel, "selection")
    chosen = sel.select(county, F.explode("features").alias("feature"))
    fit = stats.ols(moments, county, feats, target, tails=tails, allowed=chosen)
    hists = chosen_histograms(numeric, sel, county, feats)
    return AccidentResult(counts, acc, screen, sel, hists, fit)


@dataclass
class ForecastResult:
    windows: DataFrame      # fips, start, first_day, inputs, targets, is_test
    coef: DataFrame         # fips, n_windows, coef
    predictions: DataFrame  # fips, pos, pred (overlap-resolved, test part)
    errors: DataFrame       # fips, n, mae, mse, status (every county of the readings)


def aqi_forecast(daily: DataFrame, key: str = "fips", day: str = "dt", value: str = "mean",
                 width: int = 15, n_inputs: int = 10, n_test: int = 3000,
                 how: str = "last") -> ForecastResult:
    """Chain 3 for every county at once (the original runs one county on the driver). A county
    without training windows (at most ``n_test`` windows) has status ``too_few_windows``."""
    w = series.sliding_windows(daily, key, day, value, width=width, n_inputs=n_inputs)
    w = series.tail_holdout(w, key, n_test=n_test)
    coef = fit_ar(w.where(~F.col("is_test")), key, n_inputs=n_inputs, horizon=width - n_inputs)
    pred = predict_ar(w.where("is_test"), coef, key)
    resolved = series.overlap_resolve(pred.where(F.col("pred").isNotNull()), key)
    errors = series.forecast_error(pred.where(F.col("pred").isNotNull()), key, "targets", "pred")
    errors = rollup.join_groups(daily.select(key).distinct(), errors, key, "left").withColumn(
        "status", F.when(F.col("n").isNull(), "too_few_windows").otherwise("ok"))
    return ForecastResult(w, coef, resolved, errors)
