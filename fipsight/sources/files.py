"""Delimited text sources and sinks.

* every file's own header line is dropped (``header=True`` is applied per file by Spark's CSV
  reader, unlike skipping the first line of the first partition only);
* columns are taken by name; nothing is inferred from data;
* the source file of a row is available through the ``_metadata.file_path`` column, so a
  parameter encoded in a path (e.g. a pollutant code) becomes a column without one read per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             schema: T.StructType | str | None = None, header: bool = True,
             encoding: str | None = None, corrupt_col: str | None = None,
             sep: str = ",") -> DataFrame:
    """CSV with a header line in every file.

    Without ``schema`` every column is a string named by the header, to be selected by name. With
    ``schema`` its columns are taken by name and converted (a value that does not convert is NULL, a
    column that the files lack is NULL); a file whose header differs from the first one's raises
    instead of landing in the wrong columns. Nothing is inferred from the data. Without a header
    line (``header=False``) the schema is by position.

    ``encoding`` handles non-UTF-8 files (e.g. ``'ISO-8859-1'``). With ``corrupt_col`` lines of the
    wrong shape or with a value that does not convert are kept (PERMISSIVE) and their text lands in
    that string column.
    """
    files = list(paths) if not isinstance(paths, str) else paths
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if encoding:
        r = r.option("encoding", encoding)
    if schema is None:
        return r.option("inferSchema", False).option("enforceSchema", False).csv(files)
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    extra = [T.StructField(corrupt_col, T.StringType())] if corrupt_col else []
    if not header:
        return r.schema(T.StructType(list(schema.fields) + extra)).csv(files)
    names = r.option("inferSchema", False).csv(files).columns
    text = r.option("enforceSchema", False).schema(
        T.StructType([T.StructField(c, T.StringType()) for c in names] + extra)).csv(files)
    typed, failed = [], F.lit(False)
    found = {c.lower(): c for c in names}  # names as Spark resolves them, whatever their case
    for f in schema.fields:
        if f.name.lower() not in found:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{found[f.name.lower()]}`")
        value = raw.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        failed = failed | (raw.isNotNull() & value.isNull())
    if corrupt_col:
        line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names])
        typed.append(F.coalesce(F.col(corrupt_col), F.when(failed, line)).alias(corrupt_col))
    return text.select(*typed)


def with_path_token(df: DataFrame, out: str, pattern: str, group: int = 1) -> DataFrame:
    """Add a column taken from the source file path by a regular expression (e.g. the pollutant
    code of ``daily_44201_1990.csv`` with ``r'daily_([^_/]+)_'``)."""
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def read_series_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Headerless ``county,date,value`` lines (the daily-mean hand-over format)."""
    return (spark.read.schema("fips string, dt date, aqi double").option("header", False)
            .csv(list(paths) if not isinstance(paths, str) else paths))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """Stage hand-over as a (partitioned) Parquet/CSV dataset; later reads prune partitions.

    Overwriting a partitioned dataset replaces the partitions that ``df`` has rows in and leaves the
    others, so a chain that runs once for each pollutant keeps the earlier ones, and running it again
    for one gives the same dataset. A partition of which ``df`` has no row any more stays. Without
    ``partition_by`` the whole dataset is replaced."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with a header (final small report). The exchange of ``repartition(1)`` keeps the
    upstream plan parallel; only the write is one task. Meant for reduced result tables."""
    df.repartition(1).write.mode(mode).option("header", True).csv(path)
