"""Floating feature selection by k-NN accuracy in groups that are too large for one task: one job a round.

A round scores, for every group still searching, all subsets that its next decision may need: the current
subset with one more feature (each) and with one feature less (each but the last added). Every subset's
neighbours are found by boxes of a k-d tree (``boxes``), so a round's work follows the rows. Dropping is decided
before adding, both from the same round; a round in which a feature is dropped wastes the other half.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.operators.boxes import box_rows, site_fold_counts
from fipsight.operators.moments import map_groups
from fipsight.operators.rollup import join_groups

_BEST = "array<struct<size: int, score: double, subset: array<int>>>"
_STATE = f"pool array<int>, subset array<int>, added int, done boolean, best {_BEST}"


def candidates(pool: Sequence[int], subset: Sequence[int], added: int, k: int) -> dict[int, list[int]]:
    """Subsets that a round scores, by number: f for one more feature f, -1 - y for feature y less (never
    the one just added)."""
    out = {f: [*subset, f] for f in pool if f not in subset} if len(subset) < k else {}
    if len(subset) > 2:
        out |= {-1 - y: [x for x in subset if x != y] for y in subset if y != added}
    return out


def step(state: dict, scores: dict[int, float], k: int) -> dict:
    """A group's search after one round: drop a feature if that beats the best subset of the smaller size,
    else add the best one."""
    subset, added, done = list(state["subset"]), state["added"], False
    best = {b["size"]: (b["score"], list(b["subset"])) for b in state["best"]}
    size = len(subset) - 1
    fewer = max(((scores[-1 - y], -y) for y in subset if y != added), default=None) if len(subset) > 2 else None
    if fewer is not None and not (size in best and fewer[0] <= best[size][0]):
        subset = [x for x in subset if x != -fewer[1]]
        best[size] = (fewer[0], sorted(subset))
    elif len(subset) >= k:
        done = True
    else:
        value, neg = max((scores[f], -f) for f in state["pool"] if f not in subset)
        added, subset = -neg, [*subset, -neg]
        if len(subset) not in best or value > best[len(subset)][0]:
            best[len(subset)] = (value, sorted(subset))
        done = len(subset) >= k and len(subset) <= 2
    return {"pool": state["pool"], "subset": subset, "added": added, "done": done,
            "best": [{"size": n, "score": v, "subset": s} for n, (v, s) in sorted(best.items())]}


def mean_score(accuracies: list[float]) -> float:
    """Mean over the folds, the same whatever their order, so that equal subsets tie."""
    return math.fsum(accuracies) / len(accuracies) if accuracies else float("nan")


def vote(labels: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Majority label along the last axis among the valid entries, ties to the smallest label."""
    if labels.shape[-1] <= 2:  # two votes agree or tie
        return np.where(valid, labels, np.iinfo(np.int64).max).min(-1)
    votes = ((labels[..., :, None] == labels[..., None, :]) & valid[..., None, :]).sum(-1)
    votes = np.where(valid, votes, 0)
    return np.where(votes == votes.max(-1, keepdims=True), labels, np.iinfo(np.int64).max).min(-1)


def round_counts(points: DataFrame, state: DataFrame, group: list[str], k: int, n_neighbors: int,
                 block_rows: int) -> DataFrame:
    """(group, cand, fold, n_test, n_correct) of every candidate of the groups in ``state``: each candidate
    is a group of its own, of the points' chosen features."""
    def each(row: dict) -> list[tuple]:
        return [(c, idx) for c, idx in candidates(row["pool"], row["subset"], row["added"], k).items()]

    chosen = map_groups(state.select(*group, "pool", "subset", "added"), group, each, T.StructType.fromDDL("cand int, idx array<int>").fields)
    rows = join_groups(points, chosen, group).select(
        *group, "cand", "id", "label", "fold", F.transform("idx", lambda i: F.get("x", i)).alias("vec"))
    return site_fold_counts(rows, [*group, "cand"], n_neighbors, box_rows(block_rows))


def search_large(points: DataFrame, groups: DataFrame, group: list[str], k: int, n_neighbors: int,
                 block_rows: int) -> DataFrame:
    """(group, subset, score) of the groups ``(group, n, pool)``. ``points``: (group, id, label, fold, x, _gn).
    Two actions a round: one that scores and decides, one that asks whether a group is left."""
    state = groups.select(*group, F.col("n").alias("_gn"), "pool", F.array().cast("array<int>").alias("subset"),
                          F.lit(-1).alias("added"), F.lit(False).alias("done"), F.array().cast(_BEST).alias("best"))
    state = state.checkpoint(eager=True)
    fields = [T.StructField("_gn", T.LongType()), *T.StructType.fromDDL(_STATE).fields]

    def decide(row: dict) -> list[tuple]:
        each: dict[int, list] = {}
        for c in row["counts"]:
            if c["n_test"]:
                each.setdefault(c["cand"], []).append(c["n_correct"] / c["n_test"])
        scores = {c: mean_score(each.get(c, [])) for c in candidates(row["pool"], row["subset"], row["added"], k)}
        new = step(row, scores, k)
        return [(row["_gn"], *(new[f.name] for f in fields[1:]))]

    while not (active := state.where("NOT done")).isEmpty():
        counts = round_counts(points, active, group, k, n_neighbors, block_rows)
        told = counts.groupBy(*group).agg(F.collect_list(F.struct("cand", "fold", "n_test", "n_correct")).alias("counts"))
        asked = join_groups(active, told, group, "left").withColumn("counts", F.coalesce("counts", F.array()))
        state = map_groups(asked, group, decide, fields).unionByName(state.where("done")).checkpoint(eager=True)
    best = state.select(*group, F.explode("best").alias("b")).where(F.col("b.size") == k)
    return best.select(*group, F.col("b.subset").alias("subset"), F.col("b.score").alias("score"))
