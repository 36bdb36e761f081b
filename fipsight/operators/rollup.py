"""Rollups and joins of exposure (daily readings) and outcome (yearly rates) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fipsight.functions.casts import int_code
from fipsight.functions.keys import year_of_id


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_groups(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on group keys in which a NULL key matches a NULL key; the keys come once. Without keys it
    would be a cross join, so that is refused."""
    k = _keys(keys)
    if not k:
        raise ValueError("a group join needs at least one key")
    named = right.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(k)],
                         *[c for c in right.columns if c not in k])
    cond = F.lit(True)
    for i, c in enumerate(k):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return left.join(named, cond, how).drop(*[f"_k{i}" for i in range(len(k))])


def mean_expr(value: Column | str) -> Column:
    """Mean as ``sum / count`` of the non-NULL values (the partial/final aggregation Spark plans)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(v) / F.count(v)


def daily_mean(df: DataFrame, keys, ts: str, value: str, out: str = "mean",
               day: str = "dt") -> DataFrame:
    """Mean reading per (key, calendar day) across all monitors of the key.

    One hash aggregate with map-side partial sums: rows of a hot key are combined before the
    shuffle, so skew on the key does not reach the reducers. Text that is no date gives a NULL day.
    """
    k = _keys(keys)
    return (df.where(F.col(value).isNotNull())
              .groupBy(*k, F.col(ts).try_cast("date").alias(day))
              .agg(mean_expr(value).alias(out), F.count(value).alias("n_readings")))


def yearly_mean(daily: DataFrame, keys, day: str = "dt", value: str = "mean", out: str = "mean",
                start: int | None = None, end: int | None = None,
                period: str = "year", period_of: Column | None = None) -> DataFrame:
    """Mean of daily means per (key, year): every day weighs the same, whatever its reading count.

    Years outside ``[start, end]`` are dropped (the filter is pushed below the aggregate).
    ``period_of`` replaces the calendar year by another period of the day (e.g. a month number).
    """
    k = _keys(keys)
    yr = F.year(F.col(day))
    if period_of is not None:
        yr = period_of
    d = daily
    if start is not None:
        d = d.where(yr >= start)
    if end is not None:
        d = d.where(yr <= end)
    return (d.groupBy(*k, yr.alias(period))
             .agg(mean_expr(value).alias(out), F.count(value).alias("n_days")))


def sum_by_key_period(df: DataFrame, keys, period: str | Column, value: str,
                      out: str = "total", where: Column | None = None,
                      period_name: str = "year") -> DataFrame:
    """Sum of ``value`` per (key, period), optionally restricted by a predicate (e.g. one sex code)."""
    k = _keys(keys)
    if where is not None:
        df = df.where(where)
    p = F.col(period) if isinstance(period, str) else period
    return df.groupBy(*k, p.alias(period_name)).agg(F.sum(value).alias(out))


def dense_period_grid(table: DataFrame, keys, period: str, value: str, start: int, end: int,
                      out: str | None = None) -> DataFrame:
    """Every key of ``table`` × every period ``start..end``, with the value or NULL.

    The table holds one row per (key, period). Each key's values (at most ``end-start+1``) are
    gathered in one aggregate and the grid is generated per key with ``explode(sequence)``: one
    shuffle, no cross join. Periods outside the range are dropped.
    """
    k = _keys(keys)
    out = out or value
    keyed = (table.groupBy(*k)
                  .agg(F.map_from_entries(F.collect_list(
                      F.when((F.col(period) >= start) & (F.col(period) <= end),
                             F.struct(F.col(period).cast("int"), F.col(value))))).alias("_m")))
    grid = keyed.select(*k, "_m", F.explode(F.sequence(F.lit(start), F.lit(end))).alias(period))
    return grid.select(*k, period, F.try_element_at(F.col("_m"), F.col(period)).alias(out))


def paired_series(exposure: DataFrame, outcome: DataFrame, keys, period: str,
                  x: str, y: str) -> DataFrame:
    """Exposure and outcome side by side per (key, period) for every key present in both tables.

    The outcome (one row per key and period) is folded to one map per key, bounded by its periods,
    and joined once on the key: keys with no common period still get their rows, with NULL ``y``,
    so the statistic downstream reports them with ``n = 0`` instead of dropping them.
    """
    k = _keys(keys)
    entry = F.when(F.col(period).isNotNull(), F.struct(F.col(period), F.col(y)))
    folded = outcome.groupBy(*k).agg(F.map_from_entries(F.collect_list(entry)).alias("_y"))
    pairs = join_groups(exposure, folded, k)
    return pairs.withColumn(y, F.try_element_at("_y", F.col(period))).drop("_y")


def valid_pair(x: str, y: str, zero_is_missing: bool = True) -> Column:
    """A usable (x, y) pair: x present and not NaN; y present (and non-zero by default)."""
    ok = F.col(x).isNotNull() & ~F.isnan(F.col(x)) & F.col(y).isNotNull() & ~F.isnan(F.col(y))
    if zero_is_missing:
        ok = ok & (F.col(y) != 0)
    return ok


def series_collect(df: DataFrame, keys, period: str, cols: Sequence[str],
                   where: Column | None = None) -> DataFrame:
    """Per key, the periods and values as parallel arrays ordered by period.

    Intended for tables with one row per (key, period): a key's arrays are bounded by the number
    of periods, not by the raw data volume.
    """
    k = _keys(keys)
    s = F.struct(F.col(period).alias("p"), *[F.col(c).alias(c) for c in cols])
    if where is not None:
        s = F.when(where, s)
    g = df.groupBy(*k).agg(F.sort_array(F.collect_list(s)).alias("_s"))
    return g.select(*k, F.transform("_s", _field("p")).alias(period + "s"),
                    *[F.transform("_s", _field(c)).alias(c + "s") for c in cols])


def _field(name: str):
    return lambda e: e[name]


def explode_series(df: DataFrame, keep: Sequence[str], arrays: Sequence[str],
                   names: Sequence[str]) -> DataFrame:
    """One row per array position: parallel arrays -> rows, other columns repeated (narrow)."""
    zipped = F.arrays_zip(*[F.col(a).alias(n) for a, n in zip(arrays, names)])
    return df.select(*keep, F.inline(zipped))


def person_rollup(persons: DataFrame, id_col: str, age: str, sex: str, restraint: str,
                  year: str | None = None, restraint_rule: str = "intended") -> DataFrame:
    """Eight person counts per accident id.

    Age bands <16, 16-29, 30-59, 60+ (codes 99 and 999 are unknown and counted nowhere; 998
    falls into 60+); sex 1 and sex 2; restraint not used / used.

    ``restraint_rule='intended'``: not used = code 17 or 20, or code 0 before 2009; used = any
    other code below 17. ``'literal'`` reproduces the operator-precedence reading of the original
    test, ``((year < 2009) & code) == 0``, true from 2009 on and for every even code before.
    The year comes from ``year`` or, by default, from the last four characters of the id.
    """
    a, s, r = int_code(age), int_code(sex), int_code(restraint)
    yr = int_code(year) if year else year_of_id(id_col)
    known = a.isNotNull() & ~a.isin(99, 999)
    if restraint_rule == "intended":
        unused = r.isin(17, 20) | ((yr < 2009) & (r == 0))
    elif restraint_rule == "literal":
        unused = r.isin(17, 20) | (yr >= 2009) | (F.pmod(r, F.lit(2)) == 0)
    else:
        raise ValueError("restraint_rule must be 'intended' or 'literal'")
    unused = F.coalesce(unused, F.lit(False))
    used = ~unused & (r < 17)

    def cnt(cond):
        return F.count_if(F.coalesce(cond, F.lit(False)))

    return persons.groupBy(id_col).agg(
        cnt(known & (a < 16)).cast("int").alias("age_lt16"),
        cnt(known & (a >= 16) & (a < 30)).cast("int").alias("age_16_29"),
        cnt(known & (a >= 30) & (a < 60)).cast("int").alias("age_30_59"),
        cnt(known & (a >= 60)).cast("int").alias("age_60p"),
        cnt(s == 1).cast("int").alias("sex1"),
        cnt(s == 2).cast("int").alias("sex2"),
        cnt(unused).cast("int").alias("restraint_unused"),
        cnt(used).cast("int").alias("restraint_used"),
    )


PERSON_COUNT_COLUMNS = ["age_lt16", "age_16_29", "age_30_59", "age_60p", "sex1", "sex2",
                        "restraint_unused", "restraint_used"]


def attach_person_counts(accidents: DataFrame, counts: DataFrame, on: str) -> DataFrame:
    """Accident rows with their eight person counts (inner equi-join on the accident id).

    Persons are already reduced to one row per id, so the join is 1:1; Spark chooses sort-merge
    or (under the size threshold, checked by the planner / AQE) broadcast.
    """
    return accidents.join(counts, on=on, how="inner")
