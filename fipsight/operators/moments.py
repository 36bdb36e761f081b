"""Mergeable moments by presence pattern: exact complete-case statistics of any set of columns.

Yearly files drift: a column is there in some years and not in others, so which rows are complete
depends on the columns that a fit uses. ``pattern_moments`` makes one aggregate keyed by the group and by
the pattern of present columns: count, means and central co-moments of the columns (packed upper
triangle). Inside a pattern every column is either always or never present, so the moments of all rows
that are complete in a set of columns are the merged moments of the patterns that contain the set:

    n = sum n_p,   mean = sum n_p mean_p / n,   C = sum C_p + sum n_p (mean_p - mean)(mean_p - mean)'

That is exact for each set, without a second pass over the data, and as stable as centred sums are.

Scale. The aggregate has map-side partial sums, so a group that holds a third of all rows is one row for
each pattern and task. A group has at most min(rows, 2^columns) patterns; files that lack whole columns make
few (one for each combination that a year's file has). One task solves a group from its patterns:
k (k + 3) / 2 doubles each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fipsight.functions.casts import finite
from fipsight.operators.rollup import _keys, join_groups


def pattern_moments(df: DataFrame, keys, features: Sequence[str], target: str) -> DataFrame:
    """``(keys, columns, present, n, mean, co)``: one row for each group and presence pattern of
    ``features``, over the rows with a target.

    ``columns`` names the features and, last, the target; ``present`` is a text of 0 and 1 in that order;
    ``mean`` and ``co`` (population covariances, upper triangle row by row) are NULL where a column is
    absent. NULL, NaN, infinite values and text that is no number are missing. A group whose targets are
    all missing has one row with n = 0.
    """
    k = _keys(keys)
    cols = [*features, target]
    last = len(cols) - 1
    base = df.select(*k, *[finite(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    flags = ", ".join(f"IF(_v{last} IS NULL OR _v{i} IS NULL, '0', '1')" for i in range(len(cols)))
    base = base.withColumn("present", F.expr(f"concat({flags})"))
    # SQL text keeps plan building cheap for many columns; rows without a target count nowhere
    mean = ", ".join(f"avg(_v{i})" for i in range(len(cols)))
    co = ", ".join(f"covar_pop(_v{i}, _v{j})" for i in range(len(cols)) for j in range(i, len(cols)))
    table = base.groupBy(*k, "present").agg(F.expr(f"count(_v{last}) AS n"), F.expr(f"array({mean}) AS mean"),
                                            F.expr(f"array({co}) AS co"))
    return table.select(*k, F.array(*[F.lit(c) for c in cols]).alias("columns"), "present", "n", "mean", "co")


class Moments:
    """All patterns of one group; ``complete`` merges those that contain a set of columns."""

    def __init__(self, columns: list[str], present: list[str], n: np.ndarray, mean: np.ndarray, co: np.ndarray):
        self.place = {c: i for i, c in enumerate(columns)}
        width = len(columns)
        self.present = np.array([[c == "1" for c in p] for p in present], bool).reshape(len(n), width)
        self.n, self.mean = n.astype(np.float64), np.nan_to_num(mean)
        self.co = np.zeros((len(n), width, width))
        upper = np.triu_indices(width)
        self.co[:, upper[0], upper[1]] = np.nan_to_num(co)
        self.co[:, upper[1], upper[0]] = self.co[:, upper[0], upper[1]]
        self.known: dict[bytes, tuple] = {}  # by set of patterns: few sets serve many sets of columns

    def complete(self, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
        """(rows, means, population covariances) of the rows in which all ``columns`` are present."""
        at = np.array([self.place[c] for c in columns])
        inside = self.present[:, at].all(1) & (self.n > 0)
        n, mean, cov = self._merged(inside)
        return n, mean[at], cov[at[:, None], at]

    def _merged(self, inside: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Moments of some patterns together, for all columns (meant for those that all of them have)."""
        key = inside.tobytes()
        if key not in self.known:
            weight, width = self.n[inside], self.mean.shape[1]
            total = weight.sum()
            if not total:
                self.known[key] = 0, np.full(width, np.nan), np.full((width, width), np.nan)
            else:
                means = self.mean[inside]
                mean = weight @ means / total
                off = means - mean
                within = np.tensordot(weight, self.co[inside], 1)
                self.known[key] = int(total), mean, (within + (off * weight[:, None]).T @ off) / total
        return self.known[key]

    def rows(self, column: str) -> int:
        return int(self.n[self.present[:, self.place[column]]].sum())


def correlations(mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(correlation matrix, which columns vary). A deviation below 1e-12 of the mean is rounding."""
    variance = np.diag(cov)
    varies = np.isfinite(variance) & (variance > 1e-24 * mean ** 2) & (variance > 0)
    spread = np.sqrt(np.where(varies, variance, 1.0))
    r = np.clip(cov / np.outer(spread, spread), -1.0, 1.0)
    np.fill_diagonal(r, 1.0)
    return r, varies


def packed_moments(moments: DataFrame, keys, allowed: DataFrame | None = None) -> DataFrame:
    """One row for each group: its patterns as parallel arrays, and ``allowed``: NULL without a
    restriction, empty for a group that the restriction does not name."""
    k = _keys(keys)
    packed = moments.groupBy(*k).agg(F.first("columns").alias("columns"),
                                     F.collect_list(F.struct("present", "n", "mean", "co")).alias("patterns"))
    if allowed is None:
        return packed.withColumn("allowed", F.lit(None).cast("array<string>"))
    named = allowed.groupBy(*k).agg(F.collect_set("feature").alias("allowed"))
    joined = join_groups(packed, named, k, "left")
    return joined.withColumn("allowed", F.coalesce("allowed", F.array().cast("array<string>")))


def map_groups(packed: DataFrame, keys, fn: Callable[[dict], list[tuple]], fields: list[T.StructField]) -> DataFrame:
    """Run ``fn(row) -> [values of fields]`` on every row of a table with one bounded row a group. The
    keys stay in Arrow, so they come back as they were (64-bit numbers beside NULL, any type)."""
    k = _keys(keys)
    own = T.StructType(fields)
    kinds = to_arrow_schema(own)
    schema = T.StructType([packed.schema[c] for c in k] + fields)
    rest = [c for c in packed.columns if c not in k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(rest).to_pylist()
            found = [(i, values) for i, row in enumerate(rows) for values in fn(row)]
            at = pa.array([i for i, _ in found], pa.int64())
            made = [pa.array([v[j] for _, v in found], kinds.field(j).type) for j in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in k] + made, [*k, *kinds.names])

    return packed.select(*k, *rest).mapInArrow(run, schema)


def map_moment_groups(moments: DataFrame, keys, fn: Callable[[Moments, set | None], list[tuple]],
                      fields: list[T.StructField], allowed: DataFrame | None = None) -> DataFrame:
    """Run ``fn(moments, allowed features or None)`` on every group of a ``pattern_moments`` table."""
    def solve(row: dict) -> list[tuple]:
        patterns, width = row["patterns"], len(row["columns"])
        number = np.array([p["n"] for p in patterns], np.int64)
        mean = np.array([p["mean"] for p in patterns], np.float64).reshape(len(patterns), width)
        co = np.array([p["co"] for p in patterns], np.float64).reshape(len(patterns), -1)
        group = Moments(row["columns"], [p["present"] for p in patterns], number, mean, co)
        return fn(group, None if row["allowed"] is None else set(row["allowed"]))

    return map_groups(packed_moments(moments, keys, allowed), keys, solve, fields)
