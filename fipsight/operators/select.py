"""Cross-validated nearest-neighbour accuracy and floating forward feature selection per group.

Scale notes
* Ranks inside a group (for stratified folds) come from a range-partitioned sort plus
  per-partition offsets, so a hot group is spread over many tasks instead of one window task.
* Exact k-nearest neighbours in few dimensions are found by boxes of a k-d tree (``boxes``), so the work
  follows the rows of a group, not their square.
* In more dimensions they are found tile by tile: a group's points are split into cells around
  pivots, distance bounds say which points may be neighbours of a cell's queries (``cells``), and each
  tile of queries and such points (about ``2 * block_rows`` rows) is one pandas task that emits only
  the ``k`` best candidates per query point; the candidates of all tiles are merged per query point.
  No pair list is materialised and no group is gathered whole.
* Feature selection with the ``'r2'`` criterion works on the group's moments only (one row for each
  pattern of present columns): no pass over the data after the one moment aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.boxes import MOST_DIMS, box_rows, site_fold_counts, site_neighbours
from fipsight.operators.cells import nearest_from_distances, nearest_in_order, neighbour_tiles, sq_dist
from fipsight.operators.moments import Moments, correlations, map_moment_groups
from fipsight.operators.rollup import _keys, join_groups
from fipsight.operators.rounds import mean_score, search_large, vote
from fipsight.session import ensure_checkpoint_dir


def distributed_row_number(df: DataFrame, keys, order: Sequence[str], out: str = "rn",
                           materialize: bool = True) -> DataFrame:
    """0-based position of every row inside its key group in ``order`` (unique order assumed).

    Rows are range-partitioned and sorted by (keys, order); a row's position is the number of
    rows of its group in earlier partitions plus its offset inside its own partition. The small
    per-(partition, group) count table carries the offsets. The sorted data is checkpointed
    (reliable checkpoint in ``spark.checkpoint.dir``) so both uses see the same partitioning.
    """
    k = _keys(keys)
    s = df.repartitionByRange(*k, *order).sortWithinPartitions(*k, *order)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid",
                                                              F.monotonically_increasing_id())
    if materialize:
        ensure_checkpoint_dir(s.sparkSession)
        s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid", *k).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*k).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    j = join_groups(s, counts.select("_pid", *k, "_off", "_m0"), ["_pid", *k])
    return j.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long")) \
            .drop("_pid", "_mid", "_off", "_m0")


def stratified_folds(df: DataFrame, group, label: str, id_col: str, folds: int = 5,
                     out: str = "fold") -> DataFrame:
    """Stratified k-fold assignment without shuffling.

    Per group, classes are taken in ascending order (libraries that number classes by first
    appearance can differ); the per-fold share of class c is the number
    of positions ``j ≡ f (mod folds)`` inside that class's slice of the label-sorted group; the
    members of c (in ``id`` order) fill fold 0 first, then fold 1, ... .
    """
    g = _keys(group)
    ranked = distributed_row_number(df, [*g, label], [id_col], out="_r")
    cls = ranked.groupBy(*g, label).agg(F.count(F.lit(1)).alias("_nk"))
    wc = Window.partitionBy(*g).orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    cls = cls.withColumn("_sk", F.coalesce(F.sum("_nk").over(wc), F.lit(0)))
    j = join_groups(ranked, cls, [*g, label])
    s, n = F.col("_sk"), F.col("_nk")

    def upto(m, f):   # count of j in [0, m] with j % folds == f  (m >= -1)
        return F.floor((m - F.lit(f) + F.lit(folds)) / F.lit(folds))

    cum = F.lit(0)
    fold = F.lit(0)
    for f in range(folds - 1):
        alloc = upto(s + n - 1, f) - upto(s - 1, f)
        cum = cum + alloc
        fold = fold + F.when(cum <= F.col("_r"), 1).otherwise(0)
    return j.withColumn(out, fold.cast("int")).drop("_r", "_nk", "_sk")


def _topk(Q: np.ndarray, Tm: np.ndarray, qf: np.ndarray, tf: np.ndarray, tids: np.ndarray,
          k: int, chunk: int = 4096, max_elems: int = 1 << 22):
    """Exact k nearest rows of ``Tm`` for every row of ``Q`` among rows of another fold;
    squared Euclidean distance, ties to the smaller id. Returns (query row, train row, dist)
    arrays ordered by query row, then rank. Memory is bounded by chunking the query rows."""
    step = max(1, min(chunk, max_elems // max(1, Tm.shape[0])))
    rs, cs, ds = [], [], []
    for s in range(0, len(Q), step):
        r, c, d = nearest_from_distances(sq_dist(Q[s:s + step], Tm), qf[s:s + step], tf,
                                          tids, k, inplace=True)
        rs.append(r + s)
        cs.append(c)
        ds.append(d)
    if not rs:
        e = np.zeros(0, int)
        return e, e, np.zeros(0)
    return np.concatenate(rs), np.concatenate(cs), np.concatenate(ds)


def _majority(qrow: np.ndarray, labels: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(majority label, has any vote) per query row; ties go to the smallest label."""
    classes, code = np.unique(labels, return_inverse=True)
    counts = np.zeros((n_rows, max(1, len(classes))), dtype=np.int64)
    np.add.at(counts, (qrow, code), 1)
    pred = classes[np.argmax(counts, axis=1)] if len(classes) else np.zeros(n_rows, np.int64)
    return pred, counts.sum(axis=1) > 0


_CAND_FIELDS = [T.StructField("qid", T.LongType()), T.StructField("qlabel", T.LongType()),
                T.StructField("qfold", T.IntegerType()), T.StructField("tid", T.LongType()),
                T.StructField("tlabel", T.LongType()), T.StructField("dist", T.DoubleType())]


def _dimensions(points: DataFrame) -> int:
    first = points.select(F.size("vec").alias("n")).first()
    return first.n if first else 0


def knn_candidates(points: DataFrame, group, k: int = 5, block_rows: int = 1024,
                   chunk: int = 4096) -> DataFrame:
    """For every point, its ``k`` nearest points of the same group in other folds.

    ``points``: ``(group..., id long, label long, fold int, vec array<double>)``. Distance is
    squared Euclidean; ties are broken by the smaller id. Returns one row per (query, neighbour).
    Distance bounds leave out what cannot be near (``boxes`` in few dimensions, else ``cells``).
    """
    g = _keys(group)
    if _dimensions(points) <= MOST_DIMS:
        near = site_neighbours(points, g, k, box_rows(block_rows))
        rows = join_groups(points, near, [*g, "fold", "vec"]).withColumn("_near", F.explode("near"))
        return rows.select(*g, F.col("id").alias("qid"), F.col("label").alias("qlabel"), F.col("fold").alias("qfold"),
                           F.col("_near.tid").alias("tid"), F.col("_near.tlabel").alias("tlabel"), F.col("_near.dist").alias("dist"))
    tiles = neighbour_tiles(points, g, k, block_rows)
    key_fields = [points.schema[c] for c in g]
    schema = T.StructType(key_fields + _CAND_FIELDS)

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pdf[pdf["_role"] == 0]
        t = pdf[pdf["_role"] == 1]
        cols = [*g, "qid", "qlabel", "qfold", "tid", "tlabel", "dist"]
        if q.empty or t.empty:
            return pd.DataFrame(columns=cols)
        Q = np.stack(q["vec"].to_numpy()).astype(np.float64)
        Tm = np.stack(t["vec"].to_numpy()).astype(np.float64)
        qf, tf = q["fold"].to_numpy(), t["fold"].to_numpy()
        tids = t["id"].to_numpy()
        r, c, d = _topk(Q, Tm, qf, tf, tids, k, chunk)
        res = pd.DataFrame({"qid": q["id"].to_numpy()[r], "qlabel": q["label"].to_numpy()[r],
                            "qfold": qf[r], "tid": tids[c],
                            "tlabel": t["label"].to_numpy()[c], "dist": d})
        for c in reversed(g):
            res.insert(0, c, pdf[c].iloc[0])
        return res[cols]

    cand = tiles.groupBy(*g, "qcell", "_qb", "_tb").applyInPandas(tile, schema)
    w = Window.partitionBy(*g, "qid").orderBy("dist", "tid")
    return cand.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def knn_fold_counts(points: DataFrame, group, k: int = 5, block_rows: int = 1024) -> DataFrame:
    """Per (group, fold): test points scored and correctly classified by a k-NN majority vote
    (ties to the smallest label) trained on the other folds of the group.

    Groups of at most ``block_rows`` points are one task each: neighbours, votes and the fold
    tally are computed together and only the tally leaves the task. Larger groups go through
    the tiled ``knn_candidates`` path and a distributed vote.
    """
    g = _keys(group)
    sizes = points.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > block_rows)
    small, big = points, None
    if not large.isEmpty():
        small = join_groups(points, large, g, "left_anti")
        big = join_groups(points, large.select(*g), g, "left_semi")
    schema = T.StructType([points.schema[c] for c in g] + [
        T.StructField("fold", T.IntegerType()), T.StructField("n_test", T.LongType()),
        T.StructField("n_correct", T.LongType())])

    def whole_group(pdf: pd.DataFrame) -> pd.DataFrame:
        X = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
        fold = pdf["fold"].to_numpy()
        ids, labels = pdf["id"].to_numpy(), pdf["label"].to_numpy()
        r, c, _ = _topk(X, X, fold, fold, ids, k)
        pred, voted = _majority(r, labels[c], len(X))
        folds_here = np.unique(fold[voted])
        pos = np.searchsorted(folds_here, fold[voted])
        out = pd.DataFrame({
            "fold": folds_here,
            "n_test": np.bincount(pos, minlength=len(folds_here)),
            "n_correct": np.bincount(pos, weights=(pred == labels)[voted],
                                     minlength=len(folds_here)).astype(np.int64)})
        for col in reversed(g):
            out.insert(0, col, pdf[col].iloc[0])
        return out.astype({"fold": "int32", "n_test": "int64", "n_correct": "int64"})

    small_counts = small.groupBy(*g).applyInPandas(whole_group, schema)
    if big is None:
        return small_counts
    if _dimensions(big) <= MOST_DIMS:
        return small_counts.unionByName(site_fold_counts(big, g, k, box_rows(block_rows)))
    cand = knn_candidates(big, g, k=k, block_rows=block_rows)
    votes = cand.groupBy(*g, "qid", "qlabel", "qfold", "tlabel").agg(F.count(F.lit(1)).alias("c"))
    wv = Window.partitionBy(*g, "qid").orderBy(F.desc("c"), "tlabel")
    pred = votes.withColumn("_r", F.row_number().over(wv)).where("_r = 1")
    big_counts = pred.groupBy(*g, F.col("qfold").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(F.col("tlabel") == F.col("qlabel")).alias("n_correct"))
    return small_counts.unionByName(big_counts)


def _complete(vec) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x))


def _points(df: DataFrame, group: list[str], id_col: str, label: str, vec: Column, name: str) -> DataFrame:
    """(group, id, label, features) of the complete rows, with ids and labels as integers that keep
    the order of the originals (ties go to the smaller id or label)."""
    p = df.select(*group, F.col(id_col).alias("id"), F.col(label).alias("label"), vec.alias(name))
    p = p.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _complete(F.col(name)))
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
    if not isinstance(p.schema["label"].dataType, whole):
        # a label's place among the distinct labels replaces it, counted over sorted partitions
        codes = p.select("label").distinct().withColumn("_one", F.lit(0))
        codes = distributed_row_number(codes, ["_one"], ["label"], out="_code").drop("_one")
        p = p.join(codes, "label").drop("label").withColumnRenamed("_code", "label")
    if not isinstance(p.schema["id"].dataType, whole):
        p = distributed_row_number(p, group, ["id"], out="_id").drop("id").withColumnRenamed("_id", "id")
    return p.select(*group, F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), name)


def incomplete_points(df: DataFrame, group, id_col: str, label: str, features) -> DataFrame:
    """Rows per group that the k-NN operators leave out: ``(group, n_rows, n_incomplete)``."""
    vec = F.col(features).cast("array<double>") if isinstance(features, str) else \
        F.array(*[F.col(c).cast("double") for c in features])
    ok = F.col(id_col).isNotNull() & F.col(label).isNotNull() & _complete(vec)
    return df.groupBy(*_keys(group)).agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_incomplete"))


def knn_cv_accuracy(df: DataFrame, group, id_col: str, label: str, features, k: int = 5,
                    folds: int = 5, block_rows: int = 1024) -> DataFrame:
    """Accuracy of a k-nearest-neighbour classifier under stratified ``folds``-fold CV per group.

    ``features``: a list of numeric columns or the name of one array column. Majority vote of
    the k neighbours, ties to the smallest label. Ids and labels may have any orderable type. Rows
    with a missing (NULL, NaN) feature, label or id have no distance and are left out before the
    folds are made; ``incomplete_points`` counts them. Returns ``(group, fold, n_test, n_correct,
    accuracy)``; the mean over folds is the cross-validation score.
    """
    g = _keys(group)
    if isinstance(features, str):
        vec = F.col(features).cast("array<double>")
    else:
        vec = F.array(*[F.col(c).cast("double") for c in features])
    pts = _points(df, g, id_col, label, vec, "vec")
    pts = stratified_folds(pts, g, "label", "id", folds)
    counts = knn_fold_counts(pts, g, k=k, block_rows=block_rows)
    return counts.withColumn("accuracy", F.col("n_correct") / F.col("n_test"))


# ------------------------------------------------------------------------------------------
# sequential forward floating selection on Gram tables
# ------------------------------------------------------------------------------------------


def _r2(R: np.ndarray, r: np.ndarray, subset: Sequence[int]) -> float:
    if not subset:
        return 0.0
    idx = list(subset)
    b = np.linalg.pinv(R[np.ix_(idx, idx)]) @ r[idx]
    return float(r[idx] @ b)


def floating_search(score: Callable[[Sequence[int]], float], p: int, k: int) -> tuple[list[int], float]:
    """SFFS over ``p`` features: add the best feature; then drop features (never the one just added)
    while a smaller subset beats the best subset of that size seen so far (the published variant that
    compares with the current subset's score stops earlier). Ties go to the lower index. Ends, since
    every step back raises the best score of a size. Returns the best subset of size ``min(k, p)``
    and its score."""
    k = min(k, p)
    subset: list[int] = []
    best: dict[int, tuple[float, list[int]]] = {}
    while len(subset) < k:
        cands = [f for f in range(p) if f not in subset]
        s, neg = max((score(subset + [f]), -f) for f in cands)
        added = -neg
        subset = subset + [added]
        if len(subset) not in best or s > best[len(subset)][0]:
            best[len(subset)] = (s, sorted(subset))
        while len(subset) > 2:
            s2, negx = max((score([x for x in subset if x != y]), -y)
                           for y in subset if y != added)
            smaller = len(subset) - 1
            if s2 > best.get(smaller, (-np.inf,))[0]:
                subset = [x for x in subset if x != -negx]
                best[smaller] = (s2, sorted(subset))
            else:
                break
    return (best[k][1], best[k][0]) if k else ([], 0.0)


def floating_forward(R: np.ndarray, r: np.ndarray, k: int) -> tuple[list[int], float]:
    """``floating_search`` with the R² of one correlation matrix as the score."""
    return floating_search(lambda subset: _r2(R, r, subset), len(r), k)


def select_features(moments: DataFrame, keys, features: Sequence[str], target: str, k: int = 10,
                    allowed: DataFrame | None = None, exclude: Sequence[str] = (),
                    min_rows: int = 10) -> DataFrame:
    """Best ``k`` features per group by floating forward selection, scored by the R² of the
    standardized least-squares fit on the complete cases of the candidate subset (from the group's
    ``pattern_moments``); a subset with fewer than ``min_rows`` complete cases, or with a column that
    does not vary in them, is no candidate.

    ``allowed`` (``(keys, feature)`` rows, e.g. the output of ``frequency_screen``) limits the
    candidates per group; ``exclude`` removes leak columns everywhere. Constant features are
    unusable. Result ``(keys, features array<string>, r2, n, status)``, ``n`` the complete cases of the
    chosen subset, with status ``ok``, ``too_few_rows`` (of the group, or of every subset of that size;
    then n counts the group's rows with a target) or ``too_few_features``.
    """
    names = [f for f in features if f not in set(exclude)]
    fields = [T.StructField("features", T.ArrayType(T.StringType())),
              T.StructField("r2", T.DoubleType()), T.StructField("n", T.LongType()),
              T.StructField("status", T.StringType())]

    def run(group: Moments, allow) -> list[tuple]:
        n, mean, cov = group.complete([target])
        if n < min_rows:
            return [([], None, n, "too_few_rows")]
        usable = [f for f in names if (allow is None or f in allow)
                  and correlations(*group.complete([f, target])[1:])[1].all()]
        if len(usable) < k or not correlations(mean, cov)[1][0]:
            return [([], None, n, "too_few_features")]
        known: dict[tuple, float] = {}

        def score(subset: Sequence[int]) -> float:
            at = tuple(sorted(subset))
            if at not in known:
                rows, m, c = group.complete([*(usable[i] for i in at), target])
                r, varies = correlations(m, c)
                fits = rows >= min_rows and varies.all()
                known[at] = _r2(r[:-1, :-1], r[:-1, -1], range(len(at))) if fits else -np.inf
            return known[at]

        chosen, best = floating_search(score, len(usable), k)
        if not np.isfinite(best):
            return [([], None, n, "too_few_rows")]
        return [([usable[i] for i in chosen], best, group.complete([*(usable[i] for i in chosen), target])[0], "ok")]

    return map_moment_groups(moments, keys, run, fields, allowed=allowed)


# ------------------------------------------------------------------------------------------
# floating forward selection scored by k-NN cross-validation (the original scoring rule)
# ------------------------------------------------------------------------------------------


#: Distances of a block of rows: few enough to stay in a core's cache through all passes over them.
_BLOCK_CELLS = 1 << 16


def _sort_codes(code: np.ndarray) -> np.ndarray:
    """Stable order of codes below the number of rows."""
    return np.argsort(code.astype(np.uint16) if len(code) < 1 << 16 else code, kind="stable")


def _equal_neighbours(order: np.ndarray, run: np.ndarray, fold: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows (n, k), complete): for every row the first ``k`` rows (in their order) that are equal and of another
    fold. ``order`` puts equal rows together in their order; ``run`` is where other ones begin."""
    f, n = fold[order], len(order)

    def ends(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(new)
        size = np.append(start[1:], n) - start
        return np.repeat(start, size), np.repeat(start + size, size)

    at, end = ends(run)
    other = run.copy()
    other[1:] |= f[1:] != f[:-1]
    beyond = np.append(ends(other)[1], n)  # the next place of other rows or another fold
    f_at = np.append(f, -1)
    rows, complete = np.zeros((n, k), np.int64), np.ones(n, bool)
    for j in range(k):
        at = np.where(f_at[at] == f, beyond[at], at)
        ok = at < end
        complete &= ok
        at = np.where(ok, at, n - 1)
        rows[order, j] = order[at]
        at = at + 1
    done = np.empty(n, bool)
    done[order] = complete
    return rows, done


class _GroupScorer:
    """Mean fold accuracy of feature positions in one group that fits a task.

    Rows that are equal in the subset are zero away, so a row with ``k`` of them in other folds has its
    neighbours there (the smallest ids). The others meet all rows, block by block: a forward candidate's distances
    are those of the current subset plus one dimension; rows of the same fold are infinitely far from the start."""

    def __init__(self, X: np.ndarray, fold: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        self.columns, self.labels, self.k, self.n = np.ascontiguousarray(X[order].T), labels[order], k, len(X)
        present, self.fold = np.unique(fold[order], return_inverse=True)
        # each fold's distances to begin with
        self.barred = np.where(np.arange(len(present))[:, None] == self.fold[None, :], np.inf, 0.0)
        self.finite = bool(np.isfinite(X).all())
        self.codes: dict[int, tuple] = {}
        self.scores: dict[tuple, float] = {}

    def coded(self, j: int) -> tuple:
        """(values, code of each row, whether unequal values are apart, squared differences if there are few)."""
        if j not in self.codes:
            values, code = np.unique(self.columns[j], return_inverse=True)
            apart = self.finite and bool(((values[1:] - values[:-1]) ** 2 > 0).all())
            table = np.subtract.outer(values, self.columns[j]) ** 2 if 4 * len(values) <= self.n else None
            self.codes[j] = values, code, apart, table
        return self.codes[j]

    def equal(self, head: Sequence[int], more: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, complete) of ``_equal_neighbours`` in ``head`` with each one of ``more``."""
        m, n = len(more), self.n
        first = np.arange(n)
        for j in head:
            first = first[_sort_codes(self.coded(j)[1][first])]
        order, run = np.empty((m, n), np.int64), np.zeros((m, n), bool)
        for i, f in enumerate(more):
            order[i] = first[_sort_codes(self.coded(f)[1][first])]
            for j in (*head, f):
                c = self.coded(j)[1][order[i]]
                run[i, 1:] |= c[1:] != c[:-1]
        run[:, 0] = True
        shift = np.arange(m)[:, None] * n
        rows, done = _equal_neighbours((order + shift).ravel(), run.ravel(), np.tile(self.fold, m), self.k)
        return rows.reshape(m, n, self.k) - np.where(done.reshape(m, n), shift, 0)[:, :, None], done.reshape(m, n)

    def squares(self, j: int, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Squared differences of ``rows`` from all rows."""
        _, code, _, table = self.coded(j)
        if table is not None:
            return np.take(table, code[rows], axis=0, out=out, mode="clip")
        np.subtract(self.columns[j][rows][:, None], self.columns[j][None, :], out=out)
        return np.multiply(out, out, out=out)

    def ready(self, head: Sequence[int], more: Sequence[int]) -> None:
        """Score ``head`` with each one of ``more``: all of them in one pass over the blocks."""
        more = [f for f in more if self._key([*head, f]) not in self.scores]
        if not more:
            return
        m, n = len(more), self.n
        if n and all(self.coded(j)[2] for j in (*head, *more)):
            at, done = self.equal(head, more)
        else:
            at, done = np.zeros((m, n, self.k), np.int64), np.zeros((m, n), bool)
        at[~done] = 0
        near = np.repeat(done[:, :, None], self.k, axis=2)
        rows = np.flatnonzero(~done.all(0))
        step = max(1, _BLOCK_CELLS // max(1, n))
        base, D, diff = (np.empty((min(step, len(rows)), n)) for _ in range(3))
        for s in range(0, len(rows), step):
            r = rows[s:s + step]
            np.take(self.barred, self.fold[r], axis=0, out=base[:len(r)], mode="clip")
            for j in head:
                base[:len(r)] += self.squares(j, r, diff[:len(r)])
            for i, f in enumerate(more):
                mine = np.flatnonzero(~done[i, r])
                to, q = D[:len(mine)], r[mine]
                np.add(base[mine] if len(mine) < len(r) else base[:len(r)], self.squares(f, q, diff[:len(mine)]), out=to)
                if not self.finite:
                    to[np.isnan(to)] = np.inf
                at[i, q], dist = nearest_in_order(to, self.k)
                near[i, q] = np.isfinite(dist)
        voted = near.any(2)
        right = (vote(self.labels[at], near) == self.labels) & voted
        p = len(self.barred)
        where = self.fold + np.arange(m)[:, None] * p
        tested, n_right = (np.bincount(where[c], minlength=m * p).reshape(m, p) for c in (voted, right))
        for f, t, c in zip(more, tested, n_right):
            self.scores[self._key([*head, f])] = mean_score([float(c[i] / t[i]) for i in np.flatnonzero(t)])

    @staticmethod
    def _key(idx: Sequence[int]) -> tuple:
        return (*sorted(idx[:2]), *idx[2:])  # the order of the others rounds the sums

    def __call__(self, idx: Sequence[int]) -> float:
        self.ready(idx[:-1], idx[-1:])
        return self.scores[self._key(idx)]


def _group_scorer(X: np.ndarray, fold: np.ndarray, ids: np.ndarray, labels: np.ndarray, n_neighbors: int) -> _GroupScorer:
    return _GroupScorer(X, fold, ids, labels, n_neighbors)


def _search_group(score, pool: Sequence[int], k: int) -> tuple[list[int], float]:
    """Floating forward search over ``pool``: the round rules of ``select_features_knn``."""
    subset: list[int] = []
    best: dict[int, tuple[float, list[int]]] = {}
    while len(subset) < k:
        if isinstance(score, _GroupScorer):
            score.ready(subset, [f for f in pool if f not in subset])
        value, neg = max((score([*subset, f]), -f) for f in pool if f not in subset)
        added = -neg
        subset = [*subset, added]
        if len(subset) not in best or value > best[len(subset)][0]:
            best[len(subset)] = (value, sorted(subset))
        while len(subset) > 2:
            value, neg = max((score([x for x in subset if x != y]), -y) for y in subset if y != added)
            size = len(subset) - 1
            if size in best and value <= best[size][0]:
                break
            subset = [x for x in subset if x != -neg]
            best[size] = (value, sorted(subset))
    return best[k][1], best[k][0]


def _group_folds(ids: np.ndarray, labels: np.ndarray, folds: int) -> np.ndarray:
    """The folds that ``stratified_folds`` gives the rows of one group."""
    order = np.lexsort((ids, labels))
    start = np.flatnonzero(np.append(True, labels[order][1:] != labels[order][:-1]))
    size = np.diff(np.append(start, len(ids)))
    f = np.arange(folds - 1)
    share = (start + size - 1)[:, None] - f + folds
    cum = (share // folds - ((start - 1)[:, None] - f + folds) // folds).cumsum(1)
    rank = np.arange(len(ids)) - np.repeat(start, size)
    fold = np.empty(len(ids), np.int64)
    fold[order] = (np.repeat(cum, size, axis=0) <= rank[:, None]).sum(1)
    return fold


def _select_small(points: DataFrame, groups: DataFrame, group: list[str], k: int, n_neighbors: int, folds: int) -> DataFrame:
    """(group, subset, score) of groups that fit one block: one task makes a group's folds and runs its whole
    search. A group's rows arrive together, after its one row of ``groups``, which has its pool and its status."""
    schema = T.StructType([points.schema[c] for c in group] + [
        T.StructField("subset", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType())])

    def search(head: pa.Table, rows: pa.Table) -> tuple | None:
        pool = head.column("pool")[0].as_py()
        if pool is None:
            return None
        X = np.asarray(rows.column("x").combine_chunks().flatten(), np.float64).reshape(len(rows), -1)
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        order = np.lexsort((labels, ids))  # of equal ids the smaller label comes first
        if (ids[order][1:] == ids[order][:-1]).any():
            order = np.lexsort((*X.T[::-1], labels, ids))
        X, ids, labels = X[order], ids[order], labels[order]
        scorer = _group_scorer(X, _group_folds(ids, labels, folds), ids, labels, n_neighbors)
        return _search_group(scorer, pool, k)

    def searched(table: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = [search(table.slice(a, 1), table.slice(a + 1, b - a - 1)) for a, b in zip(start, np.append(start[1:], len(table)))]
        at = [i for i, f in enumerate(found) if f]
        out = table.select(group).take(pa.array(start[at]))
        out = out.append_column("subset", pa.array([found[i][0] for i in at], pa.list_(pa.int32())))
        yield from out.append_column("score", pa.array([found[i][1] for i in at], pa.float64())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
            start = np.flatnonzero(held.column("head").to_numpy())
            if len(start) > 1:
                yield from searched(held.slice(0, start[-1]), start[:-1])
                held = held.slice(start[-1])
        if held is not None:
            yield from searched(held, np.array([0]))

    pool = F.when(F.col("status") == "ok", F.col("pool")).alias("pool")
    heads = groups.select(*group, F.lit(True).alias("head"), pool,
                          *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in ("id", "label", "x")])
    rows = points.select(*group, F.lit(False).alias("head"), F.lit(None).cast("array<int>").alias("pool"), "id", "label", "x")
    dealt = heads.unionByName(rows).repartition(*group).sortWithinPartitions(*group, F.desc("head"))
    return dealt.mapInArrow(run, schema)


def select_features_knn(df: DataFrame, group, id_col: str, label: str, features: Sequence[str],
                        k: int = 10, n_neighbors: int = 2, folds: int = 5,
                        allowed: DataFrame | None = None, exclude: Sequence[str] = (),
                        min_rows: int = 10, block_rows: int = 1024) -> DataFrame:
    """Sequential forward floating selection of ``k`` features per group, each subset scored by
    the mean accuracy of a ``n_neighbors``-NN classifier under stratified ``folds``-fold
    cross-validation (features unscaled, ties to the lower feature position).

    Groups of at most ``block_rows`` points are dealt once and searched whole in one task each, which makes their
    folds too; larger groups go through rounds of exact tiles, one job for all groups and candidates of a round
    (``rounds``). Both follow the same rules. Result ``(group, features, score, n, status)``.
    """
    g = _keys(group)
    names = [f for f in features if f not in set(exclude)]
    ensure_checkpoint_dir(df.sparkSession)
    pts = _points(df, g, id_col, label, F.array(*[F.col(f).cast("double") for f in names]), "x")
    sizes = pts.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    all_idx = F.array(*[F.lit(i) for i in range(len(names))])
    if allowed is not None:
        at = F.array_position(F.array(*[F.lit(f) for f in names]), F.col("feature")).cast("int") - 1
        al = allowed.withColumn("_pos", at).where(F.col("_pos") >= 0).groupBy(*g) \
            .agg(F.sort_array(F.collect_set("_pos")).alias("pool"))
        groups = join_groups(sizes, al, g, "left") \
            .withColumn("pool", F.coalesce("pool", F.array().cast("array<int>")))
    else:
        groups = sizes.withColumn("pool", all_idx)
    groups = groups.withColumn(
        "status", F.when(F.col("n") < min_rows, "too_few_rows")
                   .when(F.size("pool") < k, "too_few_features").otherwise("ok"))
    beyond = groups.where(F.col("n") > block_rows)
    few = pts if beyond.isEmpty() else join_groups(pts, beyond.select(*g), g, "left_anti")
    chosen = _select_small(few, groups.where(F.col("n") <= block_rows), g, k, n_neighbors, folds)
    large = beyond.where("status = 'ok'")
    if not large.isEmpty():
        big = join_groups(pts, large.select(*g, F.col("n").alias("_gn")), g)
        big = stratified_folds(big, g, "label", "id", folds).checkpoint(eager=True)
        chosen = chosen.unionByName(search_large(big, large, g, k, n_neighbors, block_rows))
    names_arr = F.array(*[F.lit(f) for f in names])
    final = chosen.select(
        *g, F.transform("subset", lambda i: F.element_at(names_arr, i + 1)).alias("features"),
        "score")
    out = join_groups(groups, final, g, "left")
    return out.select(*g, F.coalesce("features", F.array().cast("array<string>")).alias("features"),
                      "score", F.col("n").cast("long").alias("n"), "status")
