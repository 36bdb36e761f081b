"""Many delimited files whose headers differ, read in one scan.

The header map is the first line of every file (a few bytes each, opened by the driver as it opens the
files' metadata anyway). The files are then one CSV scan by position; each row gets its file's layout by a
join on the file path with the map (one row a file), and every column is picked by name from the position
that it has in that layout. A column that a file lacks is NULL there. The census of columns and the report
of years come from the same map, without a look at the data.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_BROADCAST_FILES = 100_000  # rows of the map, some 20 MB
HEADER_BYTES = 1 << 20


@dataclass
class HeaderMap:
    """``files``: (path, column names in order; empty for an empty file), in path order."""
    files: list[tuple[str, list[str]]]
    sep: str = ","
    encoding: str = "UTF-8"

    @property
    def columns(self) -> list[str]:
        """All column names, in the order in which the files bring them."""
        return list(dict.fromkeys(c for _, names in self.files for c in names))


def _first_line(stream, encoding: str) -> str:
    """Text up to the first line break of an open Hadoop stream."""
    raw = b""
    while b"\n" not in raw and len(raw) < HEADER_BYTES:
        part = bytes(stream.readNBytes(4096))
        if not part:
            break
        raw += part
    return raw.split(b"\n", 1)[0].decode(encoding).lstrip("﻿").rstrip("\r")


def header_map(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8") -> HeaderMap:
    """Header of every file that ``paths`` (files, folders, globs) name. A path that names nothing is
    skipped, hidden files (``_`` or ``.``) too."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = []

    def visit(fs, status) -> None:
        path = status.getPath()
        if path.getName().startswith(("_", ".")):
            return
        if status.isDirectory():
            for child in fs.listStatus(path):
                visit(fs, child)
            return
        stream = fs.open(path)
        try:
            line = _first_line(stream, encoding)
        finally:
            stream.close()
        names = [n.strip() for n in next(csv.reader([line], delimiter=sep), [])]
        files.append((path.toString(), names if any(names) else []))

    for p in [paths] if isinstance(paths, str) else paths:
        root = jvm.org.apache.hadoop.fs.Path(p)
        fs = root.getFileSystem(conf)
        for status in fs.globStatus(root) or []:
            visit(fs, status)
    return HeaderMap(sorted(dict(files).items()), sep, encoding)


def read_drifting(spark: SparkSession, headers: HeaderMap, keep: Sequence[str] | None = None,
                  path_col: str = "file_path") -> DataFrame:
    """Rows of all files with the columns ``keep`` (default: all of the map) as text, by name, and the
    path of each row's file. One scan whatever the number of layouts; a name that no file has is NULL;
    of a name that a file has twice, the first place counts. An empty field is NULL."""
    used = [(path, names) for path, names in headers.files if names]
    keep = headers.columns if keep is None else list(keep)
    if not used:
        return spark.createDataFrame([], ", ".join([*(f"`{c}` string" for c in keep), f"`{path_col}` string"]))
    layouts = list(dict.fromkeys(tuple(names) for _, names in used))
    number = {names: i for i, names in enumerate(layouts)}
    width = max(map(len, layouts))
    rows = (spark.read.schema(", ".join(f"_c{i} string" for i in range(width)))
            .option("header", True).option("enforceSchema", True).option("sep", headers.sep).option("mode", "PERMISSIVE")
            .option("encoding", headers.encoding).csv([path for path, _ in used]))
    rows = rows.select("*", F.col("_metadata.file_path").alias("_path"))
    # Spark may write a path with its special characters encoded
    told = {form: (path, number[tuple(names)]) for path, names in used for form in (path, unquote(path), _quoted(spark, path))}
    table = spark.createDataFrame([(form, path, n) for form, (path, n) in told.items()], "_path string, _file string, _layout int")
    rows = rows.join(F.broadcast(table) if len(told) <= MOST_BROADCAST_FILES else table, "_path")
    out = []
    for c in keep:
        places: dict[int, list[int]] = {}
        for names, n in number.items():
            if c in names:
                places.setdefault(names.index(c), []).append(n)
        value = F.lit(None).cast("string")
        for place, own in places.items():
            value = F.when(F.col("_layout").isin(own), F.col(f"_c{place}")).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out, F.col("_file").alias(path_col))


def _quoted(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def header_census(spark: SparkSession, headers: HeaderMap, pattern: str | None = None) -> DataFrame:
    """``(column_name, n_files)``: in how many files each column occurs. With ``pattern`` the files whose
    paths share its first group (a year's parts) are one; paths without it are left out."""
    def name(path: str) -> str | None:
        if pattern is None:
            return path
        m = re.search(pattern, path)
        return m.group(1) if m else None

    rows = [(name(path), c) for path, names in headers.files for c in set(names) if name(path) is not None]
    each = spark.createDataFrame(rows, "file string, column_name string")
    return each.groupBy("column_name").agg(F.count_distinct("file").alias("n_files"))


def year_report(spark: SparkSession, headers: HeaderMap, years: Iterable[int], pattern: str) -> DataFrame:
    """``(year, n_files, status)`` of every year wanted: ``ok``, ``empty`` (files without a header) or
    ``missing``. ``pattern`` has the year of a path as its first group."""
    found: dict[int, list[bool]] = {}
    for path, names in headers.files:
        m = re.search(pattern, path)
        if m:
            found.setdefault(int(m.group(1)), []).append(bool(names))
    rows = [(int(y), len(found.get(y, [])), "missing" if y not in found else "ok" if any(found[y]) else "empty") for y in years]
    return spark.createDataFrame(rows, "year int, n_files int, status string")
