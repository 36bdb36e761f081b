import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.llm.ann import FORWARD, REVERSE, SAMPLE, aged, both_ways, neighbours_of_rows, sampled


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = x @ x[list(ids).index(q)]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_recall_on_the_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours_of_rows(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    pdf = rows.toPandas()
    want = brute(pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(float), [i for i in pdf.vec_id if i % 20 == 0], 20)
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(mine) == set(want) and all(len(v) == 20 for v in mine.values())
    hit = sum(len({i for i, _ in mine[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.95 * 20 * len(want)
    true = {q: dict(w) for q, w in want.items()}
    assert all(abs(s - true[q][i]) < 1e-12 for q, v in mine.items() for i, s in v if i in true[q])
    assert all([s for _, s in v] == sorted((s for _, s in v), reverse=True) for v in mine.values())


def test_lengths_copies_and_ties(spark):
    """Not normalised vectors, many copies of one; inner product decides, then the smaller id."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.5, 3, (300, 1))
    x[100:200] = x[100]
    rows = [(i, v.tolist(), "clash", 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, sim int").repartition(5)
    got = {}
    for r in neighbours_of_rows(df, F.col("vec_id") % 10 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(np.arange(300), x, range(0, 300, 10), 20)
    for q, w in want.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in w])
    assert [i for i, _ in got[100]][:3] == [i for i, _ in want[100]][:3]


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [1.0, 2.0, 3.0]), (8, [0.5, 0.5]), (None, [1.0, 1.0]), (20, [0.0, -1.0]), (20, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours_of_rows(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 8, 0.5), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 8, -0.5)]
    assert neighbours_of_rows(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours_of_rows(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_edges_stay_new_until_they_are_introduced(spark):
    """Node 0 has 40 new neighbours: each is introduced once, none is forgotten."""
    rows = [(0, i, float(-i), FORWARD | REVERSE) for i in range(1, 41)]
    edges, seen = spark.createDataFrame(rows, "node long, nbr long, sim float, fresh int"), []
    for turn in range(3):
        met = spark.createDataFrame(sampled(edges, turn).collect(), "hub long, node long, side int, fresh int")
        new = [r.node for r in met.collect() if r.side == FORWARD and r.fresh]
        assert len(new) <= SAMPLE // 2
        seen += new
        edges = spark.createDataFrame(aged(edges, met).collect(), "node long, nbr long, sim float, fresh int")
        left = {r.nbr for r in edges.collect() if r.fresh & FORWARD}
        assert left == set(range(1, 41)) - set(seen) and edges.where(f"fresh >= {REVERSE}").isEmpty()
    assert sorted(seen) == list(range(1, 41))


def test_a_search_follows_edges_back(spark):
    edges = spark.createDataFrame([(9, 1, 0.5, 0), (1, 2, 0.9, 0), (2, 1, 0.9, 0)], "node long, nbr long, sim float, fresh int")
    assert sorted(map(tuple, both_ways(edges, 2).collect())) == [(1, 2), (1, 9), (2, 1), (9, 1)]
