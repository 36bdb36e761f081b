"""A round of NN-descent over packed tables against the same round with a row an edge."""

import numpy as np
import pytest

from fipsight.llm import ann, descent
from fipsight.llm.descent import FORWARD, REVERSE


def packed(spark, nodes, rows, buckets):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from descent.edge_rows(*(batch.column(c).to_numpy() for c in range(4)), buckets)
    edges = spark.createDataFrame(rows, ann.EDGE).repartition(3).mapInArrow(run, descent.ROW)
    return descent.state_of(descent.packed_nodes(nodes, buckets, ann._matrix).unionByName(edges), 5)


@pytest.mark.parametrize("buckets", [1, 4])
def test_a_packed_round_gives_the_edges_of_a_round_by_rows(spark, monkeypatch, buckets):
    monkeypatch.setattr(ann, "DEGREE", 5)
    rng = np.random.default_rng(buckets)
    ids = rng.permutation(10 ** 6)[:60] - 10 ** 5
    x = dict(zip(ids.tolist(), rng.normal(size=(60, 4)).astype(np.float32)))
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in x.items()], "node long, vec binary").repartition(2)
    rows = [(int(ids[i]), int(ids[j]), float(x[ids[i]] @ x[ids[j]]), FORWARD | REVERSE if i % 3 else i % 2 * REVERSE)
            for i in range(60) for j in rng.permutation(60)[:5] if i != j]
    edges = spark.createDataFrame(rows, ann.EDGE)
    want = {(r.node, r.nbr): r for r in ann.best_edges(edges.unionByName(
        ann.introduced(edges, ann.sampled(edges, 0), nodes)), 5).collect()}
    state = packed(spark, nodes, rows, buckets)
    asked = descent.lists(state, 0, buckets, ann.SAMPLE)
    # rows between buckets, not edges
    assert asked.count() <= buckets + buckets ** 2
    state = descent.state_of(state.unionByName(descent.introduced(state, asked, buckets, 5)), 5)
    got = {(r.node, r.nbr): r for r in descent.plain_edges(state, ann.EDGE).collect()}
    assert set(got) == set(want)
    assert all(got[e].fresh == want[e].fresh and abs(got[e].sim - want[e].sim) < 1e-5 for e in want)
    assert state.agg({"n": "sum"}).first()[0] == sum(r.fresh > 0 for r in want.values())


def test_best_edges_of_each_node():
    node, nbr = np.array([3, 1, 1, 1, 3, 1]), np.array([9, 5, 4, 5, 8, 6])
    sim, fresh = np.array([1, 2, 2, 2, 3, 1], np.float32), np.array([3, 3, 3, 1, 3, 3], np.uint8)
    got = descent.best(node, nbr, sim, fresh, 2)
    assert [a.tolist() for a in got] == [[1, 1, 3, 3], [4, 5, 8, 9], [2.0, 2.0, 3.0, 1.0], [3, 1, 3, 3]]
    assert all(len(a) == 0 for a in descent.best(*(a[:0] for a in (node, nbr, sim, fresh)), 2))
