"""Frequent values of many columns per group, without a shuffle of their distinct values.

A continuous column has as many distinct values as rows, so a histogram of all columns sends every row and
column through the shuffle, only to learn that no value is frequent. Here each task keeps, for every
(group, column), a summary of at most ``capacity`` counters: rows of equal values are counted, and when
there are more values than counters, the largest count that does not fit is taken off all of them. What
was taken off is the summary's error: a value's true count lies between its counter and its counter plus
the error, and the error is at most rows / (capacity + 1).

Summaries merge by adding counters and errors, so the shuffle holds at most ``capacity`` rows for each task,
group and column, whatever the number of distinct values. With four counters for each 1 / share, most values
are then known to be frequent or not; only those whose bounds straddle the threshold are counted exactly, in
a second pass over the data that is left out when there are none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.rollup import _keys, join_groups
from fipsight.session import ensure_checkpoint_dir

HELD_ROWS = 200_000  # rows that a task counts before it cuts their values to the capacity; counters of half as many stay


def _sum(table: pa.Table, by: list[str]) -> pa.Table:
    """Counts ``c`` added up over equal ``by`` columns (NULL and NaN equal themselves)."""
    out = table.group_by(by, use_threads=False).aggregate([("c", "sum")])
    return out.rename_columns([*by, "c"] if out.column_names[-1] == "c_sum" else ["c", *by])


def _cut(counts: pa.Table, keys: list[str], capacity: int) -> tuple[pa.Table, pa.Table | None]:
    """(at most ``capacity`` counters for each group, what was taken off as (keys, c))."""
    group = pa.table({k: counts.column(k) for k in keys} | {"c": pa.array(np.ones(len(counts), np.int64))})
    sizes = _sum(group, keys)
    if not len(counts) or pc.max(sizes.column("c")).as_py() <= capacity:
        return counts, None
    number = pa.table({k: sizes.column(k) for k in keys} | {"_g": pa.array(np.arange(len(sizes)))})
    # arrow joins do not match NULL keys, so groups are numbered by first appearance instead
    code = _codes(counts, number, keys)
    c = counts.column("c").to_numpy()
    order = np.lexsort((-c, code))
    g = code[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    size = np.diff(np.append(first, len(g)))
    over = size > capacity
    off = np.zeros(len(number), np.int64)
    off[g[first[over]]] = c[order][first[over] + capacity]
    left = c - off[code]
    kept = counts.set_column(counts.column_names.index("c"), "c", pa.array(left)).filter(pa.array(left > 0))
    taken = number.select(keys).append_column("c", pa.array(off))
    return kept, taken.filter(pa.array(off > 0))


def _codes(counts: pa.Table, number: pa.Table, keys: list[str]) -> np.ndarray:
    """Row number in ``number`` of each row's group."""
    both = pa.concat_tables([number.select(keys), counts.select(keys)])
    code = np.zeros(len(both), np.int64)
    for k in keys:
        index = both.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        code = np.unique(np.stack([code, index]), axis=1, return_inverse=True)[1].ravel() if len(keys) > 1 else index
    place = np.empty(code.max() + 1, np.int64)
    place[code[:len(number)]] = np.arange(len(number))
    return place[code[len(number):]]


def value_summaries(df: DataFrame, keys, features: Sequence[str], capacity: int) -> DataFrame:
    """``(keys, feature position _fi, n, err, counters array<struct<value, low>>)`` for each group and column."""
    k = _keys(keys)
    own = [f"_k{i}" for i in range(len(k))]
    rows = df.select(*[F.col(c).alias(o) for c, o in zip(k, own)],
                     *[F.col(f).cast("double").alias(f"_v{i}") for i, f in enumerate(features)])
    schema = T.StructType([rows.schema[o] for o in own] + T.StructType.fromDDL(
        "_fi int, _total boolean, value double, low long, err long, n long").fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [[] for _ in features]
        taken: list = [[] for _ in features]
        sizes: list = []
        waiting = 0  # rows since the last cut

        def cut(i: int) -> int:
            kept, off = _cut(_sum(pa.concat_tables(held[i]), [*own, "value"]), own, capacity)
            held[i] = [kept]
            if off is not None:
                taken[i].append(off)
            return len(kept)

        def given() -> Iterator[pa.RecordBatch]:
            for i in range(len(features)):
                kept = held[i][0]
                parts = [(False, kept.column("value"), kept.column("c"), 0, 0, kept)]
                parts += [(True, None, 0, t.column("c"), 0, t) for t in taken[i]] + [(True, None, 0, 0, sizes[0].column("c"), sizes[0])]
                for total, value, low, err, n, t in parts:
                    m = len(t)
                    full = lambda x: pa.array(np.zeros(m, np.int64)) if isinstance(x, int) else x
                    cells = [pa.array(np.full(m, i, np.int32)), pa.array(np.full(m, total)),
                             pa.nulls(m, pa.float64()) if value is None else value, full(low), full(err), full(n)]
                    yield from pa.table([t.column(o) for o in own] + cells, names).to_batches(max_chunksize=50_000)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            one = pa.array(np.ones(len(table), np.int64))
            sizes.append(_sum(table.select(own).append_column("c", one), own))
            for i in range(len(features)):
                v = table.column(f"_v{i}")
                v = pc.if_else(pc.equal(v, 0.0), 0.0, v)  # -0.0 is 0.0
                held[i].append(_sum(table.select(own).append_column("value", v).append_column("c", one), [*own, "value"]))
            waiting += len(table)
            if waiting >= HELD_ROWS:
                waiting = 0
                sizes = [_sum(pa.concat_tables(sizes), own)]
                # many groups: their counters leave the task, which starts again, so that no row is summed
                # again with every batch; summaries merge by adding
                if max([cut(i) for i in range(len(features))]) + len(sizes[0]) > HELD_ROWS // 2:
                    yield from given()
                    held, taken, sizes = [[] for _ in features], [[] for _ in features], []
        if sizes:
            sizes = [_sum(pa.concat_tables(sizes), own)]
            for i in range(len(features)):
                cut(i)
            yield from given()

    merged = rows.mapInArrow(run, schema).groupBy(*own, "_fi", "_total", "value").agg(
        F.sum("low").alias("low"), F.sum("err").alias("err"), F.sum("n").alias("n"))
    table = merged.groupBy(*own, "_fi").agg(
        F.sum("n").alias("n"), F.sum("err").alias("err"),
        F.collect_list(F.when(~F.col("_total"), F.struct("value", "low"))).alias("counters"))
    return table.select(*[F.col(o).alias(c) for c, o in zip(k, own)], "_fi", "n", "err", "counters")


def feature_screen(df: DataFrame, keys, features: Sequence[str], share: float = 0.1, min_values: int = 2,
                   var: str = "feature", capacity: int | None = None) -> DataFrame:
    """``frequency_screen`` of all columns straight from wide rows: ``(group, feature, n_frequent)`` of the
    features for which at least ``min_values`` distinct values (NULL is one) each cover ``share`` of the
    group's rows. Starts a job (the summaries), and a second one if a value's bounds do not decide."""
    k = _keys(keys)
    ensure_checkpoint_dir(df.sparkSession)
    capacity = max(math.ceil(1 / share), capacity or math.ceil(4 / share))
    pct = round(share * 100)
    whole = abs(pct - share * 100) < 1e-9

    def frequent(count, n):
        return count * F.lit(100) >= n * F.lit(int(pct)) if whole else count >= n * F.lit(share)

    s = value_summaries(df, k, features, capacity)
    s = s.select(*k, "_fi", "n", F.filter("counters", lambda c: frequent(c["low"], F.col("n"))).alias("sure"),
                 F.filter("counters", lambda c: ~frequent(c["low"], F.col("n")) & frequent(c["low"] + F.col("err"), F.col("n")))
                 .alias("open")).checkpoint(eager=True)
    open_ = s.select(*k, "_fi", "n", F.explode("open").alias("c")).select(*k, "_fi", "n", F.col("c.value").alias("value"))
    found = s.select(*k, "_fi", F.size("sure").alias("m"))
    if not open_.isEmpty():
        long = df.select(*k, F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("_fi", "value"))
        wanted = join_groups(long, open_, [*k, "_fi", "value"])
        counts = wanted.groupBy(*k, "_fi", "value").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
        found = found.unionByName(counts.where(frequent(F.col("c"), F.col("n"))).select(*k, "_fi", F.lit(1).alias("m")))
    names = F.array(*[F.lit(f) for f in features])
    found = found.groupBy(*k, "_fi").agg(F.sum("m").cast("int").alias("n_frequent")).where(F.col("n_frequent") >= min_values)
    return found.select(*k, F.element_at(names, F.col("_fi") + 1).alias(var), "n_frequent")


def chosen_histograms(df: DataFrame, selection: DataFrame, keys, features: Sequence[str], var: str = "feature",
                      val: str = "value", features_col: str = "features") -> DataFrame:
    """Histograms of each group's chosen features only (``selection``: one row a group with an array of
    names): ``(group, feature, value, cnt, n_rows)``. A row is unfolded into the chosen columns of its
    group, not into all."""
    k = _keys(keys)
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.col(f).cast("double"))])
    rows = join_groups(df.select(*k, values.alias("_values")), selection.select(*k, F.col(features_col).alias("_chosen")), k)
    long = rows.select(*k, "_values", F.explode("_chosen").alias(var))
    counts = long.groupBy(*k, var, F.try_element_at("_values", F.col(var)).alias(val)).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(*k, var).agg(F.sum("cnt").alias("n_rows"))
    return join_groups(counts, totals, [*k, var]).select(*k, var, val, "cnt", "n_rows")
