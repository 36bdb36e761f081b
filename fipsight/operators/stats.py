"""Group statistics from distributed moments: z-scores, correlation, Gram tables, OLS, p-values.

Nothing here gathers a group's rows: every statistic is a sum/moment aggregate (map-side partial
aggregation, so a hot group costs one more partial row per task, not one huge task). Only the
k×k solve of a regression leaves the JVM, on the already-reduced moments of a group
(``moments.pattern_moments``: one row for each pattern of present columns).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.functions.casts import finite
from fipsight.functions.tails import t_tail
from fipsight.operators.moments import Moments, correlations, map_moment_groups
from fipsight.operators.rollup import _keys, join_groups, valid_pair


def group_standardize(df: DataFrame, keys, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add ``<col>_z = (col - mean) / population std`` per group (NULL when the std is 0).

    Means and stds come from one aggregate (partial + final), joined back on the group key; the
    planner broadcasts the per-group stats when they are small and AQE splits a skewed key.
    """
    k = _keys(keys)
    stats = df.groupBy(*k).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                               *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = join_groups(df, stats, k)
    return j.select(*df.columns, *[((F.col(c) - F.col(f"_m_{c}")) /
                                     F.nullif(F.col(f"_s_{c}"), F.lit(0.0))).alias(c + suffix)
                                    for c in cols])


def correlation_expr(x: Column, y: Column) -> Column:
    """Pearson r as covar_pop / (std_x * std_y); NULL (not an error) for a constant side."""
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def group_correlation(pairs: DataFrame, keys, x: str, y: str, period: str | None = None,
                      min_n: int = 10, zero_is_missing: bool = True,
                      with_series: bool = False, out: str = "beta") -> DataFrame:
    """Standardized one-variable regression slope per group, i.e. Pearson correlation.

    With both sides z-scored by their population std the least-squares slope X'Y/X'X equals
    r. Pairs with a missing / NaN x, a missing y or (``zero_is_missing``) a zero y are left out;
    groups with fewer than ``min_n`` usable pairs get NULL. ``with_series`` adds the usable
    periods and values as arrays sorted by period (needs one row per (group, period)).
    """
    k = _keys(keys)
    ok = valid_pair(x, y, zero_is_missing)
    xv, yv = F.when(ok, F.col(x)), F.when(ok, F.col(y))
    n = F.count_if(ok)
    aggs = [n.cast("int").alias("n"),
            F.when(n >= min_n, correlation_expr(xv, yv)).alias(out)]
    if with_series:
        if period is None:
            raise ValueError("with_series needs the period column")
        aggs.append(F.sort_array(F.collect_list(
            F.when(ok, F.struct(F.col(period).alias("p"), F.col(x).alias("x"),
                                F.col(y).alias("y"))))).alias("_s"))
    g = pairs.groupBy(*k).agg(*aggs)
    if with_series:
        g = g.select(*k, "n", out,
                     F.transform("_s", lambda e: e["p"]).alias(period + "s"),
                     F.transform("_s", lambda e: e["x"]).alias(x + "s"),
                     F.transform("_s", lambda e: e["y"]).alias(y + "s"))
    return g


def gram_table(df: DataFrame, keys, features: Sequence[str], target: str) -> DataFrame:
    """Long Gram table of z-scored features and target per group, from one moment aggregate.

    Rows ``(keys, f1, f2, gram, n)`` with ``gram = Σ z_f1 z_f2 = n·r(f1, f2)`` for every feature
    pair (f1 <= f2 in the given order), every feature with the target (``f2 = target``: X'y), and
    the target with itself (``y'y = n``). ``n`` counts the group's rows with a target.

    Correlations come from merged central moments (``covar_pop`` over the two standard deviations,
    partial aggregation), so a large mean costs no precision. Available cases: a pair's covariance
    uses the rows in which both columns are present, a deviation all rows of its column (NULL, NaN
    and infinite values are missing), so a column that drifts out of some years does not remove the other columns' rows.
    A feature without spread, or without rows, in a group has ``gram = NULL``. Such pairwise entries
    describe the data; they need not fit together as one matrix where values are missing, so fits use
    the complete cases of ``pattern_moments``.
    The aggregate is written as SQL text, which keeps plan building cheap for many features.
    """
    k = _keys(keys)
    feats = list(features)
    cols = feats + [target]
    last = len(cols) - 1
    base = df.select(*k, *[finite(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    pairs = [(i, j) for i in range(len(feats)) for j in [*range(i, len(feats)), last]] + [(last, last)]
    aggs = [f"count(_v{last}) AS _n"]
    aggs += [f"stddev_pop(_v{i}) AS _d{i}" for i in range(len(cols))]
    aggs += [f"covar_pop(_v{i}, _v{j}) AS _c{i}_{j}" for i, j in pairs if i != j]
    m = base.groupBy(*k).agg(*[F.expr(a) for a in aggs])
    rows = []
    for i, j in pairs:
        spread = f"_d{i} > 0 AND _d{j} > 0"
        value = "_n" if i == j else f"_n * _c{i}_{j} / (_d{i} * _d{j})"
        rows.append(f"struct({i} AS _i, {j} AS _j, CASE WHEN {spread} THEN CAST({value} AS DOUBLE) END AS gram)")
    name = F.array(*[F.lit(c) for c in cols])
    return (m.select(*k, F.col("_n").cast("long").alias("n"), F.expr(f"inline(array({', '.join(rows)}))"))
            .select(*k, F.get(name, F.col("_i")).alias("f1"), F.get(name, F.col("_j")).alias("f2"), "gram", "n"))


_OLS_FIELDS = [T.StructField("feature", T.StringType()), T.StructField("beta", T.DoubleType()),
               T.StructField("t", T.DoubleType()), T.StructField("dof", T.LongType()),
               T.StructField("status", T.StringType())]


def ols(moments: DataFrame, keys, features: Sequence[str], target: str, se: str = "pooled",
        tails: int = 1, allowed: DataFrame | None = None) -> DataFrame:
    """Standardized multivariate OLS per group with t statistics and p-values.

    Input is ``pattern_moments`` output for these columns (or more). A group is fitted on its complete
    cases: the rows that have the target and every fitted feature, z-scored over those rows. Per group
    numpy solves ``b = pinv(R) r``; the residual sum of squares comes from the moments,
    ``rss = n (1 - 2 b'r + b'R b)``, so the data is not read a second time. ``dof = n - (1 + k)`` with n the
    complete cases. ``se='pooled'`` uses one standard error ``sqrt(s² / ΣX²)`` for every coefficient (ΣX²
    over the whole standardized matrix); ``se='coef'`` uses ``sqrt(s² · pinv(G)_ii)``. The tail
    probability is evaluated JVM-side (``t_tail``), one-sided by default.

    Statuses: ``constant`` for a feature without spread (or without rows) in the group, or in the complete
    cases: it is left out, and the complete cases are those of the others; ``constant_target``;
    ``no_complete_rows``; ``too_few_rows`` (dof below 1: no t); ``ok``. ``allowed`` rows ``(keys, feature)``
    (e.g. a per-group selection) restrict each group's fit to its features; a group without any allowed
    feature is one row without a feature, status ``not_selected``. A perfect fit has an infinite t and
    p = 0.
    """
    all_feats = list(features)
    if se not in ("pooled", "coef"):
        raise ValueError("se must be 'pooled' or 'coef'")

    def solve(group: Moments, allow: set | None) -> list[tuple]:
        feats = all_feats if allow is None else [f for f in all_feats if f in allow]
        if not feats:
            return [(None, None, None, None, "not_selected")]
        n, mean, cov = group.complete([target])
        if not correlations(mean, cov)[1][0]:
            return [(f, None, None, None, "constant_target") for f in feats]
        alone = {f: correlations(*group.complete([f, target])[1:])[1][0] for f in feats}
        fitted, status = [f for f in feats if alone[f]], "ok"
        while fitted:
            n, mean, cov = group.complete([*fitted, target])
            if not n:
                status = "no_complete_rows"
                break
            r, varies = correlations(mean, cov)
            if not varies[-1]:
                status = "constant_target"
                break
            if varies.all():
                break
            fitted = [f for f, v in zip(fitted, varies) if v]
        if not fitted:
            return [(f, None, None, None, "constant") for f in feats]
        if status != "ok":
            return [(f, None, None, None, status if f in fitted else "constant") for f in feats]
        kk = len(fitted)
        R, xy = r[:kk, :kk], r[:kk, kk]
        P = np.linalg.pinv(R)
        b = P @ xy
        rss = n * max(float(1.0 - 2.0 * b @ xy + b @ R @ b), 0.0)
        dof = n - (1 + kk)
        out = []
        for i, f in enumerate(fitted):
            if dof <= 0:
                out.append((f, float(b[i]), None, dof, "too_few_rows"))
                continue
            s2 = rss / dof
            sei = np.sqrt(s2 / (n * kk)) if se == "pooled" else np.sqrt(s2 * P[i, i] / n)
            out.append((f, float(b[i]), float(b[i] / sei) if sei > 0 else float(np.copysign(np.inf, b[i])), dof, "ok"))
        return out + [(f, None, None, dof, "constant") for f in feats if f not in fitted]

    fitted = map_moment_groups(moments, keys, solve, _OLS_FIELDS, allowed=allowed)
    return fitted.withColumn("p_value", t_tail("t", "dof", tails=tails))
