"""Yearly files with drifting columns: merge by name, report skipped years, column census."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_years(frames: Mapping[int, DataFrame], keep: Sequence[str] | None = None,
                year_col: str = "file_year") -> DataFrame:
    """Union of yearly frames by column name (a column absent in a year is NULL there).

    ``keep`` projects a keep-list after the union; names that no year has become NULL string
    columns. Every frame gets its year in ``year_col``. The union is a narrow concatenation of
    the scans: no shuffle.
    """
    if not frames:
        raise ValueError("no yearly frame to merge")
    tagged = [df.withColumn(year_col, F.lit(int(y))) for y, df in sorted(frames.items())]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if keep is None:
        return merged
    cols = set(merged.columns)
    return merged.select(*[F.col(c) if c in cols else F.lit(None).cast("string").alias(c)
                           for c in keep], year_col)


def read_years(spark: SparkSession, path_for_year: Callable[[int], str], years: Iterable[int],
               reader: Callable[[SparkSession, str], DataFrame],
               ) -> tuple[dict[int, DataFrame], DataFrame]:
    """Open every year's file; years whose file is absent or unreadable are skipped.

    Returns the frames by year and a report ``(year int, path string, status string)`` of every
    year tried. Opening only reads file metadata / headers, not the data.
    """
    frames: dict[int, DataFrame] = {}
    report = []
    for y in years:
        p = path_for_year(y)
        try:
            df = reader(spark, p)
            _ = df.schema
            frames[y] = df
            report.append((int(y), p, "ok"))
        except Exception as exc:  # absent path, unreadable file: reported, not fatal
            report.append((int(y), p, "skipped: " + type(exc).__name__))
    schema = T.StructType([T.StructField("year", T.IntegerType()),
                           T.StructField("path", T.StringType()),
                           T.StructField("status", T.StringType())])
    return frames, spark.createDataFrame(report, schema)


def column_census(spark: SparkSession, frames: Mapping[int, DataFrame]) -> DataFrame:
    """In how many yearly files does each column occur (from the files' schemas only)."""
    rows = [(int(y), c) for y, df in frames.items() for c in df.columns]
    meta = spark.createDataFrame(rows, "year int, column_name string")
    return meta.groupBy("column_name").agg(F.count_distinct("year").alias("n_files"))


def column_presence(merged: DataFrame, year_col: str = "file_year",
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Data-side census of a merged table: per column, the number of years in which it holds
    at least one value. One aggregate over the merged rows (partial aggregation per task)."""
    cols = [c for c in (columns or merged.columns) if c != year_col]
    per_year = merged.groupBy(year_col).agg(
        *[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in cols])
    row = per_year.agg(*[F.sum(c).cast("long").alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_files"))
                      for c in cols])
    return row.select(F.inline(pairs))
