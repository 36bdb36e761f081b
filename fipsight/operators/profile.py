"""Per-group value profiles of features: long form, histograms, near-constant screen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.operators.rollup import _keys, join_groups


def unpivot_features(df: DataFrame, ids, features: Sequence[str], var: str = "feature",
                     val: str = "value") -> DataFrame:
    """Wide -> long ``(ids, feature, value double)``; one numeric type for every feature."""
    k = _keys(ids)
    cast = df.select(*k, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(k, list(features), var, val)


def value_histogram(long: DataFrame, keys, var: str = "feature", val: str = "value") -> DataFrame:
    """Count of every distinct value per (group, feature) with the group's row count ``n_rows``.

    The counts are one aggregate keyed by (group, feature, value) - a hot group is spread over its
    features and values. The group size is a second aggregate joined back (one row per group
    and feature).
    """
    k = _keys(keys)
    h = long.groupBy(*k, var, val).agg(F.count(F.lit(1)).alias("cnt"))
    tot = h.groupBy(*k, var).agg(F.sum("cnt").alias("n_rows"))
    return join_groups(h, tot, [*k, var])


def feature_histogram(df: DataFrame, keys, features: Sequence[str], var: str = "feature",
                      val: str = "value") -> DataFrame:
    """``value_histogram`` straight from wide rows: per (group, feature, value) the count and the
    group's row count, in the same shape. Features travel through the shuffle as a small
    integer position (cheaper to hash than the name); names are attached to the aggregated
    rows. NULL values are counted like any other value."""
    k = _keys(keys)
    names = F.array(*[F.lit(f) for f in features])
    arr = F.array(*[F.col(f).cast("double") for f in features])
    long = df.select(*k, F.posexplode(arr).alias("_fi", val))
    h = long.groupBy(*k, "_fi", val).agg(F.count(F.lit(1)).alias("cnt"))
    tot = h.groupBy(*k, "_fi").agg(F.sum("cnt").alias("n_rows"))
    j = join_groups(h, tot, [*k, "_fi"])
    return j.select(*k, F.element_at(names, F.col("_fi") + 1).alias(var), val, "cnt", "n_rows")


def histogram_map(hist: DataFrame, keys, var: str = "feature", val: str = "value") -> DataFrame:
    """Histogram rows -> ``map<value, count>`` per (group, feature) (bounded by distinct values)."""
    k = _keys(keys)
    return hist.groupBy(*k, var).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(val, "cnt")))).alias("histogram"))


def frequency_screen(hist: DataFrame, keys, var: str = "feature", share: float = 0.1,
                     min_values: int = 2) -> DataFrame:
    """Keep features for which at least ``min_values`` distinct values each cover ``share`` of the
    group's rows (drops constant and near-constant features). Returns
    ``(group, feature, n_frequent)``. The comparison ``cnt >= share * n_rows`` is made in exact
    integer arithmetic when ``share`` is a whole percentage."""
    k = _keys(keys)
    pct = round(share * 100)
    if abs(pct - share * 100) < 1e-9:
        frequent = F.col("cnt") * F.lit(100) >= F.col("n_rows") * F.lit(int(pct))
    else:
        frequent = F.col("cnt") >= F.col("n_rows") * F.lit(share)
    s = hist.groupBy(*k, var).agg(F.count_if(frequent).cast("int").alias("n_frequent"))
    return s.where(F.col("n_frequent") >= min_values)


def keep_selected(long: DataFrame, selection: DataFrame, keys, var: str = "feature") -> DataFrame:
    """Rows of a long feature table whose (group, feature) is in the selection (left semi join, a NULL
    group matches a NULL group; the selection has one row per group and chosen feature and is
    broadcast by the planner when small)."""
    k = _keys(keys)
    return join_groups(long, selection.select(*k, var).distinct(), [*k, var], "left_semi")


def selected_histograms(selection: DataFrame, hist: DataFrame, keys, var: str = "feature",
                        features_col: str = "features", as_map: bool = False) -> DataFrame:
    """Histograms of the features chosen per group (``selection`` holds an array of names per
    group, e.g. ``select_features`` output).

    Long rows ``(group, feature, value, cnt, n_rows)`` by default: a continuous feature can have
    as many distinct values as the group has rows, so the rows stay rows. ``as_map=True`` folds
    them into ``map<value, count>`` per (group, feature), which is meant for categorical
    features (bounded number of distinct values)."""
    k = _keys(keys)
    chosen = selection.select(*k, F.explode(features_col).alias(var))
    rows = join_groups(hist, chosen, [*k, var], "left_semi")
    return histogram_map(rows, k, var) if as_map else rows
