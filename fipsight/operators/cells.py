"""Exact k-nearest-neighbour join inside large groups with distance bounds.

A group's points are split into cells around sampled pivots (each point belongs to its nearest pivot). From
a few numbers of every cell - its radius and, for each fold, the distances of its k points nearest to the
pivot - follows how far a query of cell i may have to look: with r_i the radius of i, d_ij the distance
of the pivots and s a point of cell j in another fold,

    dist(q, s) <= r_i + d_ij + dist(s, pivot_j)

so the k-th smallest of the right side is a bound t_i on the distance of the k-th neighbour of every query
in cell i (the largest over its folds). By the triangle inequality a point s of cell j can be nearer than
t_i only if

    d_ij - r_i - t_i <= dist(s, pivot_j) <= d_ij + r_i + t_i

and only those points travel to cell i. Cells without such points are not paired at all.

Size. A group of n points has min(2 n / block_rows, sqrt(n)) cells, so the pairs of its pivots stay below n and
its cells' numbers are one bounded row each. Queries and visiting points of a cell are cut into tiles of
about ``block_rows``, so a cell that holds most points of a group is many tasks. Worst case (no bound
excludes anything: many independent dimensions, or all points alike): every point visits every cell, n
rows for each cell, as many as in the plan that compares all pairs of blocks; the comparisons are then
those of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.rollup import _keys, join_groups
from fipsight.session import ensure_checkpoint_dir

SLACK = 1e-9  # relative; bounds are widened by it, since distances are rounded


def sq_dist(Qc: np.ndarray, Tm: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
    """Squared Euclidean distances, dimensions added in column order onto ``base`` (zeros when
    omitted), so a prefix's matrix extended by one column equals the full computation."""
    D = np.zeros((len(Qc), len(Tm))) if base is None else base.copy()
    diff = np.empty_like(D)
    for j in range(Qc.shape[1]):
        np.subtract(Qc[:, j][:, None], Tm[:, j][None, :], out=diff)
        np.multiply(diff, diff, out=diff)
        D += diff
    return D


def nearest_from_distances(D: np.ndarray, qf: np.ndarray, tf: np.ndarray, tids: np.ndarray,
                            k: int, same_fold: np.ndarray | None = None,
                            inplace: bool = False):
    """Given squared distances ``D`` (query rows x train rows), the k nearest train rows of
    another fold per query row, ties to the smaller id. Returns (query row, train row, dist)
    ordered by query row, then rank. ``same_fold`` may pass the precomputed fold mask;
    ``inplace=True`` lets the function overwrite ``D`` (a scratch matrix) instead of copying."""
    mask = qf[:, None] == tf[None, :] if same_fold is None else same_fold
    if inplace:
        np.putmask(D, mask, np.inf)
    else:
        D = np.where(mask, np.inf, D)
    kk = min(k, D.shape[1])
    if kk == 0 or D.shape[0] == 0:
        e = np.zeros(0, int)
        return e, e, np.zeros(0)
    kth = np.partition(D, kk - 1, axis=1)[:, kk - 1]
    r, c = np.nonzero(D <= kth[:, None])           # k best plus distance ties
    d = D[r, c]
    fin = np.isfinite(d)
    r, c, d = r[fin], c[fin], d[fin]
    o = np.lexsort((tids[c], d, r))                # per row: by distance, then id
    r, c, d = r[o], c[o], d[o]
    pos = np.arange(len(r))
    first = np.r_[True, r[1:] != r[:-1]] if len(r) else np.zeros(0, bool)
    rank = pos - np.maximum.accumulate(np.where(first, pos, 0))
    keep = rank < k
    return r[keep], c[keep], d[keep]


def nearest_in_order(D: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(column, distance) of the ``k`` smallest entries of every row of ``D``, which is overwritten; equal
    ones go to the smaller column (put columns in id order), and what is not finite is an infinite distance.
    For a small ``k``: one pass over ``D`` for each."""
    rows, kk = np.arange(len(D)), min(k, D.shape[1])
    at, dist = np.zeros((len(D), k), np.int64), np.full((len(D), k), np.inf)
    for j in range(kk):
        at[:, j] = c = D.argmin(1)
        dist[:, j] = D[rows, c]
        D[rows, c] = np.inf
    return at, dist


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _sample(points: DataFrame, group: list[str], block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(points with _n, _cells and _ab, pivots (group, _ab, cell, pivot)): about ``_cells`` points of
    every group, by a hash of the id, given to each of the group's assignment blocks."""
    sizes = points.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(F.xxhash64("id")).alias("_least"))
    cells = F.least(F.ceil(2 * F.col("_n") / F.lit(block_rows)), F.ceil(F.sqrt("_n"))).cast("long")
    # blocks of at least four times the pivots: handing the pivots out costs less than n / 4 rows
    blocks = F.ceil(F.col("_n") / F.greatest(F.lit(block_rows), 4 * F.col("_cells"))).cast("long")
    sizes = sizes.withColumn("_cells", cells).withColumn("_nab", blocks)
    p = join_groups(points, sizes, group)
    mark = F.xxhash64("id")
    chosen = p.where((mark == F.col("_least")) | (F.pmod(F.xxhash64("id", F.lit(3)), F.col("_n")) < F.col("_cells")))
    chosen = chosen.select(*group, F.explode(F.sequence(F.lit(0), F.col("_nab") - 1)).alias("_ab"),
                           F.col("id").alias("cell"), F.col("vec").alias("pivot"))
    return p.withColumn("_ab", F.pmod(mark, F.col("_nab"))).drop("_least", "_cells", "_nab"), chosen


def assigned(points: DataFrame, group, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(points with cell and dist, pivots (group, cell, pivot)). A cell is named by its pivot's id; equal
    distances go to the smaller name."""
    g = _keys(group)
    p, pivots = _sample(points, g, block_rows)
    fields = [points.schema[c] for c in [*g, "id", "label", "fold", "vec"]]
    schema = T.StructType(fields + [T.StructField("cell", T.LongType()), T.StructField("dist", T.DoubleType())])

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left[[f.name for f in fields]]
        if left.empty:
            return left.assign(cell=pd.Series(dtype="int64"), dist=pd.Series(dtype="float64"))
        right = right.sort_values("cell")
        V, names = _matrix(right["pivot"]), right["cell"].to_numpy()
        X = _matrix(left["vec"])
        cell, dist = np.empty(len(X), np.int64), np.empty(len(X))
        step = max(1, (1 << 22) // len(V))
        for s in range(0, len(X), step):
            D = sq_dist(X[s:s + step], V)
            at = D.argmin(1)
            cell[s:s + step], dist[s:s + step] = names[at], np.sqrt(D[np.arange(len(at)), at])
        return left.assign(cell=cell, dist=dist)

    # other names: both sides come from the same columns
    own = pivots.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(g)], F.col("_ab").alias("_pb"), "cell", "pivot")
    out = p.groupBy(*g, "_ab").cogroup(own.groupBy(*[f"_p{i}" for i in range(len(g))], "_pb")).applyInPandas(nearest, schema)
    return out, pivots.where("_ab = 0").drop("_ab")


def cell_bounds(V: np.ndarray, radius: np.ndarray, near: list[tuple], folds_of: list[set], k: int) -> Iterator[tuple]:
    """(i, js, lo, hi) for every cell i: the cells js whose points with lo <= dist <= hi may be among the k
    nearest of a query in i. ``near``: (cell, fold, distance to the pivot) of each cell's and fold's k
    points nearest to the pivot; ``folds_of``: the folds of each cell's queries."""
    at = np.array([c for c, _, _ in near], np.int64)
    fold = np.array([f for _, f, _ in near], np.int64)
    far = np.array([d for _, _, d in near], np.float64)
    for i in range(len(V)):
        d = np.sqrt(sq_dist(V[i:i + 1], V)[0])
        reach = radius[i] + d[at] + far
        bound = 0.0
        for f in folds_of[i]:
            other = reach[fold != f]
            bound = max(bound, np.partition(other, k - 1)[k - 1] if len(other) >= k else np.inf)
        slack = SLACK * (d + radius[i] + (bound if np.isfinite(bound) else 0.0))
        lo, hi = d - radius[i] - bound - slack, d + radius[i] + bound + slack
        js = np.flatnonzero(radius >= lo)
        yield i, js, lo[js], hi[js]


def cell_pairs(points: DataFrame, pivots: DataFrame, group, k: int, block_rows: int) -> DataFrame:
    """(group, qcell, cell, lo, hi, n_qb, n_tb): which points of ``cell`` visit ``qcell``, and the tiles into
    which the queries and the visitors of ``qcell`` are cut."""
    g = _keys(group)
    w = Window.partitionBy(*g, "cell", "fold").orderBy("dist", "id")
    first = (points.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
             .groupBy(*g, "cell", "fold").agg(F.collect_list("dist").alias("near")))
    sizes = points.groupBy(*g, "cell", "fold").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius"))
    cells = join_groups(sizes, first, [*g, "cell", "fold"]).groupBy(*g, "cell").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), F.collect_list(F.struct("fold", "near")).alias("folds"))
    cells = join_groups(cells, pivots, [*g, "cell"])
    schema = T.StructType([points.schema[c] for c in g] + [
        T.StructField("qcell", T.LongType()), T.StructField("cell", T.LongType()), T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()), T.StructField("n_qb", T.IntegerType()), T.StructField("n_tb", T.IntegerType())])

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        names, n = pdf["cell"].to_numpy(), pdf["n"].to_numpy()
        near = [(i, x["fold"], d) for i, folds in enumerate(pdf["folds"]) for x in folds for d in x["near"]]
        folds_of = [{x["fold"] for x in folds} for folds in pdf["folds"]]
        parts = []
        for i, js, lo, hi in cell_bounds(_matrix(pdf["pivot"]), pdf["radius"].to_numpy(), near, folds_of, k):
            parts.append(pd.DataFrame({"qcell": names[i], "cell": names[js], "lo": lo, "hi": hi,
                                       "n_qb": -(-n[i] // block_rows), "n_tb": max(1, -(-n[js].sum() // block_rows))}))
        out = pd.concat(parts).astype({"n_qb": "int32", "n_tb": "int32"})
        for c in reversed(g):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    return cells.groupBy(*g).applyInPandas(pair, schema)


def neighbour_tiles(points: DataFrame, group, k: int, block_rows: int) -> DataFrame:
    """Rows ``(group, qcell, _qb, _tb, _role, id, label, fold, vec)``: in every tile the queries (role 0)
    of a part of a cell and the points (role 1) that may be among their ``k`` nearest."""
    g = _keys(group)
    ensure_checkpoint_dir(points.sparkSession)
    placed, pivots = assigned(points, g, block_rows)
    placed = placed.checkpoint(eager=True)
    pairs = cell_pairs(placed, pivots, g, k, block_rows).checkpoint(eager=True)
    row = ["id", "label", "fold", "vec"]
    tiles = pairs.select(*g, F.col("qcell").alias("cell"), "n_qb", "n_tb").distinct()

    def part(count: str, salt: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count)).cast("int")

    def each(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    queries = join_groups(placed, tiles, [*g, "cell"]).select(
        *g, F.col("cell").alias("qcell"), part("n_qb", 5).alias("_qb"), each("n_tb").alias("_tb"), F.lit(0).alias("_role"), *row)
    visits = join_groups(placed, pairs, [*g, "cell"]).where(F.col("dist").between(F.col("lo"), F.col("hi")))
    visitors = visits.select(*g, "qcell", each("n_qb").alias("_qb"), part("n_tb", 7).alias("_tb"), F.lit(1).alias("_role"), *row)
    return queries.unionByName(visitors)
