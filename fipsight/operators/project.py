"""Projections and row filters on raw extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fipsight.functions.casts import bool_text_flag, equals_flag, safe_double
from fipsight.functions.clock import day_of_year0, hours_between, parse_timestamp


def select_keep(df: DataFrame, keep: Sequence[str], missing_type: str = "string") -> DataFrame:
    """Keep-list projection by name; a listed name the input lacks becomes a NULL column, so
    yearly extracts with drifting columns share one schema. Pruned down to the scan."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(missing_type).alias(c)
                       for c in keep])


def exclude_label(df: DataFrame, col: str, label: str) -> DataFrame:
    """Drop rows whose label equals ``label``; NULL labels are kept (null-safe comparison)."""
    return df.where(~F.col(col).eqNullSafe(F.lit(label)))


def min_length(df: DataFrame, col: str, longer_than: int) -> DataFrame:
    """Keep rows whose text is longer than ``longer_than`` characters (e.g. drop 2-digit state
    rows, keep 5-digit counties)."""
    return df.where(F.length(F.col(col)) > longer_than)


def numeric_where(df: DataFrame, cond: Column, value: str) -> DataFrame:
    """Rows meeting ``cond`` whose ``value`` text parses as a finite number (blank, garbage,
    NaN and infinity are rejected)."""
    return df.where(cond & safe_double(value).isNotNull())


def feature_prep(df: DataFrame, start: str, end: str, side: str, flags: Sequence[str],
                 numeric: Mapping[str, str] | None = None, keep: Sequence[str] = (),
                 drop: Sequence[str] = (), ts_format: str | None = None,
                 side_value: str = "R", false_text: str = "False") -> DataFrame:
    """Derived accident features appended to the kept columns (one wide row per accident).

    year, month, zero-based day of year of ``start``; duration ``start -> end`` in hours (2
    decimals, half-even); ``side`` flag (1 for ``side_value``); every column in ``flags`` as
    0 for the false text and 1 otherwise; ``numeric`` columns cast (ANSI-safe) to the given
    types. ``keep`` columns pass through, ``drop`` columns are removed.
    """
    s = parse_timestamp(start, ts_format) if ts_format else F.col(start)
    e = parse_timestamp(end, ts_format) if ts_format else F.col(end)
    derived = [F.year(s).alias("year"), F.month(s).alias("month"),
               day_of_year0(s).alias("day_of_year"), hours_between(s, e).alias("duration_h"),
               equals_flag(side, side_value).alias(side + "_flag")]
    derived += [F.col(c).cast("string").try_cast(t).alias(c) for c, t in (numeric or {}).items()]
    derived += [bool_text_flag(c, false_text).alias(c) for c in flags]
    used = set(flags) | set((numeric or {}).keys())
    passthrough = [c for c in keep if c not in used and c not in set(drop)]
    return df.select(*passthrough, *derived)
