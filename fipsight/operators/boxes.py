"""Exact k-nearest-neighbour join inside large groups, by boxes of a k-d tree.

For each test fold of a group, the points of the other folds are cut into boxes of about ``size`` points by
a k-d tree made from a sample. A query is compared with the points of its own box; the k-th smallest
distance there is a bound on its k-th neighbour's, so it then visits only the other boxes that are not
farther away than that. Equal vectors of a fold have the same neighbours, so each is one query, and only its
``k`` smallest ids are points that others may find.

Size. In few dimensions most queries visit few boxes, so the work follows the rows, not their square. A
group has min(n / size, 16 sqrt(n)) boxes, and a tree's sample is eight points a box. Queries of a box are cut into
tiles. Worst case (many dimensions, where no box is far): every query visits every box.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.cells import nearest_in_order, sq_dist
from fipsight.operators.rollup import _keys, join_groups
from fipsight.session import ensure_checkpoint_dir

SLACK = 1e-9  # relative; bounds are widened by it, since distances are rounded
SAMPLED = 8  # sampled points of a box
LEAST = 4  # sampled points on each side of a cut
MOST_DIMS = 8  # beyond, few boxes are too far to visit
_NEAR = "array<struct<dist: double, tid: bigint, tlabel: bigint>>"
_TREE = ("dim", "at", "low", "high")


def box_rows(block_rows: int) -> int:
    """Points of a box where ``block_rows`` bounds a block: small blocks would be too many tasks."""
    return max(block_rows, min(512, 4 * block_rows))


def build_tree(X: np.ndarray) -> tuple[np.ndarray, ...]:
    """(dim, at, low, high) of the inner nodes: ``x[dim] <= at`` goes to ``low``; -1 - b is box b."""
    dim, at, child, boxes = [], [], [], 0
    todo = [(np.arange(len(X)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        cut = _cut(X[rows]) if len(rows) > SAMPLED else None
        if parent >= 0:
            child[parent][side] = -1 - boxes if cut is None else len(dim)
        if cut is None:
            boxes += 1
            continue
        below = X[rows, cut[0]] <= cut[1]
        todo += [(rows[below], len(dim), 0), (rows[~below], len(dim), 1)]
        dim.append(cut[0])
        at.append(cut[1])
        child.append([0, 0])
    pairs = np.array(child, np.int32).reshape(-1, 2)
    return np.array(dim, np.int32), np.array(at, np.float64), pairs[:, 0], pairs[:, 1]


def _cut(X: np.ndarray) -> tuple[int, float] | None:
    """(dimension, value) that halves the points in their widest dimension where that can be."""
    for d in np.argsort(X.min(0) - X.max(0), kind="stable"):
        s = np.sort(X[:, d])
        for n in (np.searchsorted(s, s[(len(s) - 1) // 2], "right"), np.searchsorted(s, s[len(s) // 2], "left")):
            if LEAST <= n <= len(s) - LEAST:
                return int(d), float(s[n - 1])
    return None


def boxes_of(tree: tuple, X: np.ndarray) -> np.ndarray:
    """Box of every row."""
    dim, at, low, high = tree
    node = np.full(len(X), 0 if len(dim) else -1, np.int64)
    while (open_ := np.flatnonzero(node >= 0)).size:
        n = node[open_]
        node[open_] = np.where(X[open_, dim[n]] <= at[n], low[n], high[n])
    return (-1 - node).astype(np.int32)


def boxes_within(tree: tuple, X: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, box) of the boxes whose squared distance from the row is at most ``reach``."""
    dim, at, low, high = tree
    reach = reach * (1 + SLACK)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
    todo = [(0 if len(dim) else -1, np.arange(len(X)), np.zeros(X.shape))]
    while todo:
        node, rows, off = todo.pop()
        if node < 0:
            out.append((rows, np.full(len(rows), -1 - node, np.int32)))
            continue
        d = dim[node]
        gap = X[rows, d] - at[node]
        for to, outside in ((low[node], gap > 0), (high[node], gap <= 0)):
            there = off.copy()
            there[outside, d] = gap[outside] ** 2
            near = there.sum(1) <= reach[rows]
            if near.any():
                todo.append((to, rows[near], there[near]))
    return np.concatenate([r for r, _ in out]), np.concatenate([b for _, b in out])


def _vectors(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros((0, 1))
    return np.asarray(table.column("vec").combine_chunks().flatten(), np.float64).reshape(table.num_rows, -1)


def _tree(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The tree of a group's one row; a group without a row is one box."""
    if not table.num_rows:
        return build_tree(np.zeros((0, 1)))
    return tuple(np.asarray(table.column(c)[0].values) for c in _TREE)


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def site_neighbours(points: DataFrame, group, k: int, size: int) -> DataFrame:
    """``(group, fold, vec, near)``: for each distinct vector of a fold the ``k`` nearest points of the
    group's other folds as ``array<struct<dist, tid, tlabel>>``, nearest first, ties to the smaller id.

    ``points``: ``(group..., id long, label long, fold int, vec array<double>)``; points that are not finite
    have no distance and are no query."""
    g = _keys(group)
    ensure_checkpoint_dir(points.sparkSession)
    first = Window.partitionBy(*g, "fold", "vec").orderBy("id")
    near = points.where(F.forall("vec", lambda x: F.abs(x) < float("inf"))).select(*g, "id", "label", "fold", "vec")
    near = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k).checkpoint(eager=True)
    sizes = near.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.collect_set("fold").alias("_folds"))
    want = F.least(F.ceil(F.col("_n") / F.lit(size)), F.ceil(16 * F.sqrt("_n")))
    sizes = sizes.withColumn("_want", want.cast("long")).withColumn(
        "_nab", F.ceil(F.col("_n") / F.greatest(F.lit(16_384), 4 * F.col("_want"))).cast("long"))
    known = join_groups(near, sizes, g).withColumn("_ab", F.pmod(F.xxhash64("id"), F.col("_nab")))
    key, row = [*g, "qfold"], ["id", "label", "vec"]
    trains = known.withColumn("qfold", F.explode(F.array_remove("_folds", F.col("fold"))))
    sample = trains.where(F.pmod(F.xxhash64("id", F.lit(3)), F.col("_n")) < SAMPLED * F.col("_want"))
    keys = [points.schema[c] for c in g] + [T.StructField("qfold", T.IntegerType())]

    def build(table: pa.Table) -> pa.Table:
        made = build_tree(_vectors(table))
        return pa.table([table.column(c).slice(0, 1) for c in key]
                        + [_lists(pa.array(v), np.array([len(v)])) for v in made], [*key, *_TREE])

    trees = sample.select(*key, "vec").groupBy(*key).applyInArrow(build, T.StructType(keys + T.StructType.fromDDL(
        "dim array<int>, at array<double>, low array<int>, high array<int>").fields))
    # other names: both sides come from the same columns
    trees = join_groups(trees, sizes.select(*g, "_nab"), g).select(
        *[F.col(c).alias(f"_p{i}") for i, c in enumerate(key)], F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nab") - 1)).alias("_pb"), *_TREE)
    trees = trees.checkpoint(eager=True)

    def with_trees(rows: DataFrame, fn, fields: str) -> DataFrame:
        schema = T.StructType(keys + T.StructType.fromDDL(fields).fields)
        pair = rows.groupBy(*key, "_ab").cogroup(trees.groupBy(*[f"_p{i}" for i in range(len(key))], "_pb"))
        return pair.applyInArrow(fn, schema)

    def place(rows: pa.Table, tree: pa.Table) -> pa.Table:
        box = boxes_of(_tree(tree), _vectors(rows))
        return rows.select([*key, "_ab", "_role", *row]).append_column("box", pa.array(box))

    queries = known.where("_r = 1").withColumn("qfold", F.col("fold"))
    all_ = queries.select(*key, "_ab", F.lit(0).alias("_role"), *row).unionByName(
        trains.select(*key, "_ab", F.lit(1).alias("_role"), *row))
    fields = "_ab bigint, _role int, id bigint, label bigint, vec array<double>, box int"
    placed = with_trees(all_, place, fields).checkpoint(eager=True)
    found = _nearest_in_boxes(placed.where("_role = 0"), placed.where("_role = 1"), key, keys, k, size).checkpoint(eager=True)

    def visit(rows: pa.Table, tree: pa.Table) -> pa.Table:
        X, own = _vectors(rows), rows.column("box").to_numpy()
        at, box = boxes_within(_tree(tree), X, rows.column("reach").to_numpy())
        at, box = at[other := box != own[at]], box[other]
        return rows.select([*key, "_ab", "id", "vec"]).take(pa.array(at)).append_column("box", pa.array(box))

    reach = F.when(F.size("near") >= k, F.element_at("near", k)["dist"]).otherwise(F.lit(float("inf")))
    visits = with_trees(found.select(*key, "_ab", "id", "vec", "box", reach.alias("reach")), visit,
                        "_ab bigint, id bigint, vec array<double>, box int").checkpoint(eager=True)
    more = _nearest_in_boxes(visits, placed.where("_role = 1"), key, keys, k, size)
    # the boxes' points are disjoint
    merged = found.unionByName(more).groupBy(*key, "vec").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    return merged.withColumnRenamed("qfold", "fold")


def _nearest_in_boxes(queries: DataFrame, trains: DataFrame, key: list[str], keys: list, k: int, size: int) -> DataFrame:
    """The queries with ``near``: their nearest among the points of ``box``."""
    tiles = queries.groupBy(*key, "box").agg(F.ceil(F.count(F.lit(1)) / F.lit(4 * size)).cast("int").alias("_tiles"))
    row = [*key, "box", "_qb", "_role", "_ab", "id", "label", "vec"]
    q = join_groups(queries, tiles, [*key, "box"]).withColumn("_qb", F.pmod(F.xxhash64("id"), F.col("_tiles")).cast("int"))
    q = q.withColumn("_role", F.lit(0)).withColumn("label", F.lit(0).cast("long"))
    t = join_groups(trains, tiles, [*key, "box"]).withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))

    def tile(table: pa.Table) -> pa.Table:
        role = table.column("_role").to_numpy()
        q, t = (table.filter(pa.array(role == r)) for r in (0, 1))
        Q, X = _vectors(q), _vectors(t)
        ids, labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        order = np.argsort(ids, kind="stable")
        X, ids, labels = X[order], ids[order], labels[order]
        at, dist = np.zeros((len(Q), k), np.int64), np.full((len(Q), k), np.inf)
        step = max(1, (1 << 18) // max(1, len(X)))
        for s in range(0, len(Q) if len(X) else 0, step):
            at[s:s + step], dist[s:s + step] = nearest_in_order(sq_dist(Q[s:s + step], X), k)
        ok = np.isfinite(dist)
        near = pa.StructArray.from_arrays([pa.array(dist[ok]), pa.array(ids[at[ok]] if len(X) else np.zeros(0, np.int64)),
                                           pa.array(labels[at[ok]] if len(X) else np.zeros(0, np.int64))], ["dist", "tid", "tlabel"])
        return q.select([*key, "_ab", "id", "vec", "box"]).append_column("near", _lists(near, ok.sum(1)))

    schema = T.StructType(keys + T.StructType.fromDDL(f"_ab bigint, id bigint, vec array<double>, box int, near {_NEAR}").fields)
    return q.select(*row).unionByName(t.select(*row)).groupBy(*key, "box", "_qb").applyInArrow(tile, schema)


def site_fold_counts(points: DataFrame, group, k: int, size: int) -> DataFrame:
    """``(group, fold, n_test, n_correct)`` of a majority vote of the ``k`` nearest (ties to the smallest label)."""
    g = _keys(group)
    near = site_neighbours(points, g, k, size).where(F.size("near") > 0)
    said = F.col("near")["tlabel"]
    votes = F.transform(F.array_distinct(said), lambda c: F.struct((-F.size(F.filter(said, lambda x: x == c))).alias("n"), c.alias("c")))
    near = near.select(*g, "fold", "vec", F.array_min(votes)["c"].alias("said"))
    asked = points.groupBy(*g, "fold", "vec", "label").agg(F.count(F.lit(1)).alias("n"))
    return join_groups(asked, near, [*g, "fold", "vec"]).groupBy(*g, "fold").agg(
        F.sum("n").alias("n_test"), F.sum(F.when(F.col("label") == F.col("said"), F.col("n")).otherwise(0)).alias("n_correct"))
