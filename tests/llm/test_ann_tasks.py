"""Small tables are few tasks, whatever the number of shuffle partitions."""

import numpy as np

from fipsight.llm.ann import FORWARD, REVERSE, best_edges, introduced, sampled


def test_edges_are_dealt_without_a_fixed_number_of_partitions(spark):
    rows = spark.createDataFrame([(i % 9, i, float(i), 3) for i in range(90)], "node long, nbr long, sim float, fresh int")
    best = best_edges(rows, 2)
    assert "REPARTITION_BY_NUM" not in best._jdf.queryExecution().toString()
    assert best.count() == 18


def test_a_round_deals_rows_few_times_and_ends_the_newness_of_what_met(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, vec binary")
    rows = [(i, (i + j) % 60, float(x[i] @ x[(i + j) % 60]), FORWARD | REVERSE) for i in range(60) for j in (1, 2, 3)]
    edges = spark.createDataFrame(rows, "node long, nbr long, sim float, fresh int").repartition(2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = best_edges(edges.unionByName(introduced(edges, sampled(edges, 0), nodes)), 64)
        dealt = known._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        got = {(r.node, r.nbr): (r.sim, r.fresh) for r in known.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert dealt <= 6  # edges by hub, members by node, nodes, worst, members by hub, edges by node; before: 8
    assert len(got) == known.count() and all(got[i, j][1] == 0 for i, j, _, _ in rows)  # three neighbours: all meet
    assert got[0, 4][1] == FORWARD | REVERSE
    assert all(np.isfinite(s) and abs(s - x[i] @ x[j]) < 1e-5 for (i, j), (s, _) in got.items())
