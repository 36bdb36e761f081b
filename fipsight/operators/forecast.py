"""Multi-step autoregressive forecast per series, fitted from Gram sums.

Each training window gives ``n_inputs`` lagged readings (plus an intercept) and ``horizon``
targets. The normal equations ``X'X`` and ``X'Y`` are plain sums over windows, computed by one
aggregate per key (partial aggregation, so a long series costs one partial row per task);
only the (p x p) solve per key runs in Python, on one reduced row per key. Prediction is a
JVM-side expression over the coefficient arrays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.moments import map_groups
from fipsight.operators.rollup import _keys, join_groups


def fit_ar(windows: DataFrame, keys, inputs: str = "inputs", targets: str = "targets",
           n_inputs: int = 10, horizon: int = 5, ridge: float = 0.0) -> DataFrame:
    """Least-squares coefficients per key: ``coef[h] = [intercept, w_1 .. w_n]`` for each step h
    (one linear model per step, all fitted from the same sums). ``ridge`` adds ``λI`` to the
    non-intercept diagonal."""
    k = _keys(keys)
    p = n_inputs + 1
    x = F.concat(F.array(F.lit(1.0)), F.col(inputs).cast("array<double>"))
    base = windows.select(*k, x.alias("_x"), F.col(targets).cast("array<double>").alias("_y"))
    # one SQL expression per moment keeps plan construction cheap (~120 aggregates)
    exprs = ["count(1) AS _n"]
    for i in range(p):
        exprs += [f"sum(_x[{i}] * _x[{j}]) AS xx_{i}_{j}" for j in range(i, p)]
        exprs += [f"sum(_x[{i}] * _y[{h}]) AS xy_{i}_{h}" for h in range(horizon)]
    moments = base.groupBy(*k).agg(*[F.expr(e) for e in exprs])
    fields = [T.StructField("n_windows", T.LongType()), T.StructField("coef", T.ArrayType(T.ArrayType(T.DoubleType())))]

    def solve(row: dict) -> list[tuple]:
        xx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"]
        xy = np.array([[row[f"xy_{i}_{h}"] for h in range(horizon)] for i in range(p)], float)
        if ridge:
            xx = xx + ridge * np.diag([0.0] + [1.0] * n_inputs)
        coef = np.linalg.pinv(xx) @ xy          # p x horizon
        return [(row["_n"], coef.T.tolist())]

    return map_groups(moments, k, solve, fields)


def predict_ar(windows: DataFrame, coef: DataFrame, keys, inputs: str = "inputs",
               out: str = "pred") -> DataFrame:
    """Apply fitted coefficients to windows: ``pred[h] = c[h][0] + Σ c[h][i] * inputs[i-1]``.

    The coefficient table has one row per key and is only known after the fit, so no size
    check is run up front (it would execute the fit twice); adaptive execution broadcasts it
    from its measured size at runtime. Windows of a key without a fitted model (no training
    windows) are kept with a NULL prediction."""
    k = _keys(keys)
    c = coef.select(*k, "coef")
    j = join_groups(windows, c, k, "left")
    x = F.col(inputs).cast("array<double>")

    def step(cv):
        prods = F.zip_with(F.slice(cv, F.lit(2), F.size(cv)), x, lambda a, b: a * b)
        return cv[0] + F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)

    return j.select(*[c_ for c_ in windows.columns], F.transform("coef", step).alias(out))
