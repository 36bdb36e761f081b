"""Accident preparation from yearly files, the older extract's preparation, and the component analysis.

``prepare_accidents`` goes from folders of yearly accident, auxiliary and person files to the tables that
``chains.accident_severity`` takes; ``prepare_point_accidents`` prepares the older extract (one row an
accident with place and timestamps); ``component_analysis`` ranks accident features by principal components.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fipsight.functions import composite_id, response_minutes
from fipsight.functions.casts import int_code, unparsed
from fipsight.operators.decompose import explained_variance, loadings, pca_fit, pca_scores, significance
from fipsight.operators.lookup import fips_lookup
from fipsight.operators.project import feature_prep
from fipsight.operators.rollup import join_groups
from fipsight.sources.drift import header_census, header_map, read_drifting, year_report

YEAR_OF_PATH = r"(\d{4})[^/]*/[^/]*$"


@dataclass
class Prepared:
    accidents: DataFrame       # columns kept (text), ID, file_year, response_minutes, auxiliary columns
    persons: DataFrame | None  # columns kept (text), ID, file_year
    census: DataFrame          # table, column_name, n_files
    report: DataFrame          # table, year, n_files, status
    bad: DataFrame             # table, file_year, column_name, n_bad, example


def yearly_table(spark: SparkSession, paths: str | Sequence[str], pattern: str = YEAR_OF_PATH, keep: Sequence[str] | None = None,
                 encoding: str = "UTF-8"):
    """(header map, rows with ``file_year`` from the path) of yearly files with drifting headers."""
    headers = header_map(spark, paths, encoding=encoding)
    rows = read_drifting(spark, headers, keep)
    return headers, rows.withColumn("file_year", F.regexp_extract("file_path", pattern, 1).try_cast("int")).drop("file_path")


def prepare_accidents(spark: SparkSession, accidents: str | Sequence[str], years: Iterable[int],
                      auxiliary: str | Sequence[str] | None = None, persons: str | Sequence[str] | None = None,
                      keep: Sequence[str] | None = None, keep_auxiliary: Sequence[str] | None = None,
                      keep_persons: Sequence[str] | None = None, case: str = "ST_CASE", year: str = "YEAR",
                      arrival: tuple[str, str] = ("ARR_HOUR", "ARR_MIN"), crash: tuple[str, str] = ("HOUR", "MINUTE"),
                      pattern: str = YEAR_OF_PATH, encoding: str = "UTF-8") -> Prepared:
    """Yearly files merged by column name, with the composite id, the response time and what did not parse.

    ``ID`` is the case number and the accident's year (``year``; where that column is absent or no
    number, the year of the file). Person rows take the year of their file. Accidents without a case
    number have no ID and stay. Auxiliary rows are joined to the accidents by ID (one row an accident:
    of a repeated ID the first by all columns); their columns that the accident files have too are left
    out. ``census`` and ``report`` come from the headers; ``bad`` counts by year the values that stand in a
    column needed here and are no whole number.
    """
    years = list(years)
    tables, bad = {}, []
    wanted = {"accident": (accidents, keep, [case, year, *arrival, *crash]),
              "auxiliary": (auxiliary, keep_auxiliary, [case, year]), "person": (persons, keep_persons, [case])}
    census, report = [], []
    for name, (paths, columns, needed) in wanted.items():
        if paths is None:
            continue
        columns = None if columns is None else list(dict.fromkeys([*columns, *needed]))
        headers, rows = yearly_table(spark, paths, pattern, columns, encoding)
        for c in needed:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None).cast("string"))
        at = F.coalesce(int_code(year), F.col("file_year")) if name != "person" else F.col("file_year")
        rows = rows.withColumn("_year", at).withColumn("ID", composite_id(case, "_year")).drop("_year")
        tables[name] = rows
        census.append(header_census(spark, headers).select(F.lit(name).alias("table"), "*"))
        report.append(year_report(spark, headers, years, pattern).select(F.lit(name).alias("table"), "*"))
        told = unparsed(rows, {c: int_code(c) for c in needed}, by=["file_year"])
        bad.append(told.select(F.lit(name).alias("table"), "*"))
    acc = tables["accident"].withColumn("response_minutes", response_minutes(*arrival, *crash))
    if "auxiliary" in tables:
        more = [c for c in tables["auxiliary"].columns if c not in acc.columns]
        one = tables["auxiliary"].where("ID IS NOT NULL").groupBy("ID").agg(F.min(F.struct(*more)).alias("_a"))
        acc = join_groups(acc, one, ["ID"], "left").select(*acc.columns, *[F.col(f"_a.{c}").alias(c) for c in more])

    def together(frames):
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return Prepared(acc, tables.get("person"), together(census), together(report), together(bad))


def prepare_point_accidents(raw: DataFrame, lookup: DataFrame, start: str = "Start_Time", end: str = "End_Time", side: str = "Side",
                            county: str = "County", state: str | None = None, flags: Sequence[str] = (),
                            numeric: Mapping[str, str] | None = None, keep: Sequence[str] = (),
                            drop: Sequence[str] = ()) -> DataFrame:
    """The older extract: derived features of ``feature_prep`` with the county's key in ``fips``, looked up by
    name (``state`` given: by name and state). Unknown counties have a NULL key; timestamps that do not
    parse give NULL features. ``lookup``: (fips, name, state)."""
    rows = raw.where("true")
    found = fips_lookup(rows, lookup, county, state, on_name_only=state is None)
    return feature_prep(found, start, end, side, flags, numeric, keep=["fips", *keep], drop=drop,
                        ts_format="yyyy-MM-dd HH:mm:ss")


@dataclass
class Components:
    scores: DataFrame        # kept columns, target, scores (NULL where a feature is missing)
    variance: DataFrame      # component, variance, ratio, cumulative
    loadings: DataFrame      # feature, component, loading
    significance: DataFrame  # feature, significance, most significant first


def component_analysis(accidents: DataFrame, features: Sequence[str], target: str, k: int | None = None,
                       exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> Components:
    """Principal components of the standardized ``features`` (without ``exclude`` and the target; text that is
    no number is missing), the components' variances, and the features ranked by their loadings. ``k``
    components, as many as there are features if not given."""
    feats = [f for f in features if f not in {*exclude, target}]
    kept = list(dict.fromkeys([*keep, target]))
    rows = accidents.select(*kept, *[F.col(f).try_cast("double").alias(f"f_{i}") for i, f in enumerate(feats)])
    fit = pca_fit(rows, [f"f_{i}" for i in range(len(feats))], k or len(feats), keep=kept)
    fit.features = feats
    spark = accidents.sparkSession
    found = loadings(spark, fit)
    return Components(pca_scores(fit, keep=kept), explained_variance(spark, fit), found, significance(found))
