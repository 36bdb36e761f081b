"""Principal components of standardized features: one pass of mergeable co-moments, driver eigen-solve.

Each task reduces its rows to their number, the means and the central co-moments of all columns (packed
upper triangle, p (p + 3) / 2 doubles), batch by batch. Tasks' tables merge pairwise

    C = C_a + C_b + (m_a - m_b)(m_a - m_b)' n_a n_b / (n_a + n_b)

in two levels of at most FAN tables each, so the driver gets some tables of bounded size whatever the number
of rows or tasks. Number of rows, means, deviations and covariance come from that one pass; only the p x p
eigen-decomposition runs on the driver, so p must stay moderate (hundreds to a few thousands).

Conventions of the original analysis are kept: features are scaled by the *population* std, explained
variances are those of the population-scaled data with an n-1 denominator, and loadings are
``component * sqrt(explained variance)``. Component signs are fixed so that the entry of largest magnitude
is positive.

Rows that lack a value (NULL, NaN, infinite, a shorter array) take no part in the fit; scores are NULL
there. A constant feature has no spread: it is scaled to 0 and has loading 0. Without complete rows, or
with features that are all constant, components, variances and ratios are 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 64


@dataclass
class PcaFit:
    rows: DataFrame            # kept columns + "_a" (array of the features)
    components: np.ndarray     # p x k, signs fixed
    ratio: np.ndarray          # explained variance ratio, k
    variance: np.ndarray       # explained variance (population-scaled data), k
    mean: np.ndarray           # p
    std: np.ndarray            # p, population
    n: int                     # complete rows
    features: list[str]


def _whole(width: int) -> Column:
    """The array ``_a`` holds ``width`` finite values."""
    finite = F.forall("_a", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size("_a") == width) & finite, F.lit(False))


def merge_moments(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray] | None:
    """(n, means, central co-moments) of the union of disjoint row sets."""
    out = None
    for n, mean, co in parts:
        if out is None:
            out = (n, mean.copy(), co.copy())
        elif n:
            m, old, c = out
            d = mean - old
            c += co
            c += np.outer(d, d)[np.triu_indices(len(d))] * (m * n / (m + n))
            out = (m + n, old + d * (n / (m + n)), c)
    return out


def _moments(X: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = X.mean(0)
    Z = X - mean
    return len(X), mean, (Z.T @ Z)[np.triu_indices(X.shape[1])]


def _told(table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Moments in the rows of an Arrow table, one at a time."""
    n = table.column("n").to_pylist()
    for i in range(table.num_rows):
        yield n[i], *(np.asarray(table.column(c)[i].values, np.float64) for c in ("mean", "co"))


def _row(found: tuple | None, part: int, make=pa.table):
    n, mean, co = found
    return make([pa.array([part]), pa.array([n]), pa.array([mean], pa.list_(pa.float64())), pa.array([co], pa.list_(pa.float64()))],
                ["part", "n", "mean", "co"])


def column_moments(rows: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, means, population covariance) of the complete arrays ``_a``, in one pass."""
    schema = "part long, n long, mean array<double>, co array<double>"

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0

        def each():
            nonlocal part
            for batch in batches:
                part = batch.column(1)[0].as_py() if batch.num_rows else part
                if batch.num_rows:
                    yield _moments(np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, width))

        found = merge_moments(each())
        if found is not None:
            yield _row(found, part, pa.RecordBatch.from_arrays)

    def merge(table: pa.Table) -> pa.Table:
        return _row(merge_moments(_told(table)), int(table.column("part")[0].as_py()) // FAN)

    told = rows.where(_whole(width)).select("_a", F.spark_partition_id().cast("long").alias("part")).mapInArrow(reduce, schema)
    for _ in range(2):
        told = told.groupBy(F.floor(F.col("part") / FAN).alias("to")).applyInArrow(merge, schema)
    found = merge_moments(_told(told.toArrow()))
    if found is None:
        return 0, np.zeros(width), np.zeros((width, width))
    n, mean, co = found
    cov = np.zeros((width, width))
    cov[np.triu_indices(width)] = co / n
    return n, mean, cov + np.triu(cov, 1).T


def pca_fit(df: DataFrame, features: Sequence[str] | str, k: int,
            keep: Sequence[str] = (), width: int | None = None) -> PcaFit:
    """Standardize and fit ``k`` principal components. ``features``: list of numeric columns
    or the name of one array column (its positions become ``f0, f1, ...``; ``width`` is its length,
    looked up in the data if not given)."""
    if isinstance(features, str):
        arr = F.col(features).cast("array<double>")
        if width is None:
            width = df.agg(F.max(F.size(features))).first()[0] or 0
        names = [f"f{i}" for i in range(width)]
    else:
        arr = F.array(*[F.col(c).cast("double") for c in features])
        names = list(features)
    p = len(names)
    rows = df.select(*keep, arr.alias("_a"))
    n, mean, cov = column_moments(rows, p)
    std = np.sqrt(np.diag(cov))
    std = np.where(std > 1e-12 * np.abs(mean), std, 0.0)
    scale = np.where(std > 0, std, 1.0)
    factor = n / (n - 1) if n > 1 else 1.0
    R = cov / np.outer(scale, scale) * np.outer(std > 0, std > 0)
    values, vectors = np.linalg.eigh(R) if p else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(values)[::-1][:k]
    values, pc = np.maximum(values[order], 0.0), vectors[:, order].copy()
    total = float((std > 0).sum())          # each non-constant scaled column has variance 1
    if not total:
        values, pc = np.zeros(len(order)), np.zeros_like(pc)
    for j in range(pc.shape[1]):
        if pc[np.argmax(np.abs(pc[:, j])), j] < 0:
            pc[:, j] = -pc[:, j]
    return PcaFit(rows, pc, values / total if total else values, values * factor, mean, std, n, names)


def pca_scores(fit: PcaFit, keep: Sequence[str] = (), out: str = "scores") -> DataFrame:
    """Component scores of every row (population-std scaling, fixed signs), as an array; NULL for a row
    that lacks a value."""
    keep = list(keep)
    mean, weight = fit.mean, fit.components / np.where(fit.std > 0, fit.std, 1.0)[:, None]
    k = weight.shape[1]
    rows = fit.rows.select(*keep, F.when(_whole(len(fit.features)), F.col("_a")).alias("_a"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arr = batch.column(len(keep))
            there = np.asarray(arr.is_valid())
            X = np.asarray(arr.drop_null().flatten(), np.float64).reshape(int(there.sum()), len(mean))
            edge = np.append(0, np.cumsum(there * k)).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(edge), pa.array(((X - mean) @ weight).ravel()), mask=pa.array(~there))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), made], [*keep, out])

    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(score, schema)


def explained_variance(spark, fit: PcaFit) -> DataFrame:
    """``(component, variance, ratio, cumulative)``: the running total is a window over the k
    component rows."""
    rows = [(j, float(v), float(r)) for j, (v, r) in enumerate(zip(fit.variance, fit.ratio))]
    df = spark.createDataFrame(rows, "component int, variance double, ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum("ratio").over(w))


def loadings(spark, fit: PcaFit) -> DataFrame:
    """Long ``(feature, component, loading)`` with loading = component * sqrt(variance)."""
    L = fit.components * np.sqrt(fit.variance)[None, :]
    rows = [(fit.features[i], j, float(L[i, j])) for i in range(L.shape[0])
            for j in range(L.shape[1])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


def significance(load: DataFrame) -> DataFrame:
    """Per feature ``sqrt(Σ loading²)`` over the fitted components, most significant first."""
    s = load.groupBy("feature").agg(F.sqrt(F.sum(F.col("loading") * F.col("loading")))
                                    .alias("significance"))
    return s.orderBy(F.desc("significance"), "feature")
