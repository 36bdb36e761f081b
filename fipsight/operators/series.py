"""Ordered series per key: sliding reading windows, tail holdout, overlap resolution, errors.

Inputs here are already-aggregated series (one reading per key and day), so a key's partition of
a window is bounded by its number of days, not by the raw data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fipsight.operators.rollup import _keys


def sliding_windows(series: DataFrame, keys, order: str, value: str, width: int = 15,
                    n_inputs: int = 10, drop_last: bool = True) -> DataFrame:
    """Windows of ``width`` consecutive readings per key (gaps in dates are not filled).

    One row per window start ``0 .. n-width-1`` when ``drop_last`` (the original leaves out the
    last full window, so ``n`` readings give ``n - width`` windows), else ``0 .. n-width``. Each
    window is split into ``inputs`` (first ``n_inputs``) and ``targets`` (the rest). A single
    window specification (one sort per key partition) serves the row number, the count and the
    frame.
    """
    k = _keys(keys)
    w = Window.partitionBy(*k).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = w.rowsBetween(0, width - 1)
    last_start = width + 1 if drop_last else width
    df = series.select(*k, order, value,
                       (F.row_number().over(w) - 1).alias("start"),
                       F.count(F.lit(1)).over(whole).alias("_n"),
                       F.collect_list(value).over(ahead).alias("_win"))
    df = df.where(F.col("start") <= F.col("_n") - last_start)
    return df.select(*k, "start", F.col(order).alias("first_" + order),
                     F.slice("_win", 1, n_inputs).alias("inputs"),
                     F.slice("_win", n_inputs + 1, width - n_inputs).alias("targets"))


def tail_holdout(windows: DataFrame, keys, start: str = "start", n_test: int = 3000) -> DataFrame:
    """Mark the last ``n_test`` windows of every key as test (``is_test``), the rest as train."""
    k = _keys(keys)
    last = F.max(start).over(Window.partitionBy(*k))
    return windows.withColumn("is_test", F.col(start) > last - F.lit(n_test))


def overlap_resolve(preds: DataFrame, keys, start: str = "start", pred: str = "pred",
                    how: str = "last") -> DataFrame:
    """Multi-step predictions of overlapping windows -> one value per series position.

    Window ``s`` predicts positions ``s .. s+h-1``. ``how='last'`` keeps the value written last,
    i.e. from the window with the largest start (position p takes step 1 of window p, the final
    h-1 positions come from the later steps of the last window); ``how='avg'`` averages all
    predictions of a position. N windows of horizon h give N + h - 1 positions. The aggregate is
    keyed by (key, position), so a long series spreads over many reducers.
    """
    k = _keys(keys)
    ex = preds.select(*k, start, F.posexplode(pred).alias("_step", "_p"))
    ex = ex.withColumn("pos", F.col(start) + F.col("_step"))
    if how == "last":
        agg = F.max_by("_p", start)
    elif how == "avg":
        agg = F.avg("_p")
    else:
        raise ValueError("how must be 'last' or 'avg'")
    return ex.groupBy(*k, "pos").agg(agg.alias(pred))


def forecast_error(df: DataFrame, keys, actual: str = "targets", pred: str = "pred") -> DataFrame:
    """Mean absolute and mean squared error per key over all steps of all (test) windows."""
    k = _keys(keys)
    ex = df.select(*k, F.inline(F.arrays_zip(F.col(actual).alias("a"), F.col(pred).alias("p"))))
    d = F.col("a") - F.col("p")
    dd = d.cast("double")
    return ex.groupBy(*k).agg(F.count(d).alias("n"), F.avg(F.abs(d)).alias("mae"),
                              F.avg(dd * dd).alias("mse"))
