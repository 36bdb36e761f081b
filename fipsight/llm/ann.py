"""Approximate nearest neighbours by inner product: a graph from NN-descent, greedy graph search.

Equal vectors are one node. Each vector gets one more component that brings all of them to the
largest norm, so that the nearest by inner product is the nearest in the graph's space.

The graph starts from brute force inside the leaves of random hyperplane trees; a leaf of more than
``LEAF`` nodes is dealt at random to several. NN-descent then repeats Spark joins: every node
introduces a sample of its forward and reverse neighbours to each other (pairs with at least one
new member), and each node keeps its ``degree`` best. A hub's reverse neighbours are sampled before
they meet, so no group grows with the data. An edge stays new in a direction until it was in that
direction's sample. Rounds end when few edges are new.

A round of NN-descent deals rows four times, packed by buckets of nodes (``descent``): edges by hub, where samples
are taken; the sampled members by node, where they get their vectors; these by hub, where pairs meet; the new edges,
the old ones and the marks of what was introduced by node. ``sampled``, ``introduced`` and ``best_edges`` are the same
round with a row an edge; the packed one is tested against them. A round of a search deals four times as well. Rows
are dealt by key without a number of partitions, so that Spark joins small ones into few tasks.

A search starts at given nodes, expands the best unexpanded nodes of every query's list through the
graph's edges and each node's ``degree`` best reverse edges in rounds of joins, and ends when each
list's best nodes are all expanded.

Cases: null and zero vectors, vectors with null or non-finite components and vectors of another
length than most take no part; ties go to the smaller vec_id; repeated rows with one vec_id count
once; fewer candidates than ``k`` are all returned; empty table = no rows; clashing extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fipsight.llm.descent import (FORWARD, REVERSE, ROW, best, bucket_count, edge_rows, ended, lists, packed_nodes, plain_edges,
                                  state_of)
from fipsight.llm.descent import introduced as introduced_packed
from fipsight.llm.groups import first_of_groups, whole_groups
from fipsight.llm.store import Folder

LEAF = 512  # nodes of a leaf, at most on average
DEGREE = 64  # neighbours of a node; fit for vectors without clusters
SAMPLE = 32  # new neighbours, and old ones, that a node introduces in a round
TREES = 4
BEAM = 64
ENTRIES = 32  # nodes at which every search starts beside its own


def usable_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, vec (array<double>) of the vectors that take part."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
                & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                & F.exists("vec", lambda x: x != 0)).dropDuplicates(["vec_id"])
    usual = v.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).select("size")
    return v.join(F.broadcast(usual), F.size("vec") == F.col("size"), "left_semi")  # one row


def _matrix(column, dtype=np.float32) -> np.ndarray:
    """Rows of a binary column of packed numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data.view(dtype).reshape(n, -1)


def _binary_rows(m: np.ndarray) -> pa.Array:
    width = m.shape[1] * m.itemsize
    off = (np.arange(len(m) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(off.tobytes()),
                                                       pa.py_buffer(np.ascontiguousarray(m).tobytes())])


def best_edges(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` best (sim, then smaller nbr) edges of each node; a repeated edge is new in the directions
    in which all its rows are, so that a row of ``used`` ends it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_groups(batches):
            node, nbr = table.column("node").to_numpy(), table.column("nbr").to_numpy()
            sim, fresh = table.column("sim").to_numpy(), table.column("fresh").to_numpy()
            yield _edges(*best(node, nbr, sim, fresh, most))
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, EDGE)


#: Bits of ``fresh``: FORWARD, REVERSE: the edge has not been introduced at its node, at its neighbour
EDGE = "node long, nbr long, sim float, fresh int"


def _edges(node, nbr, sim, fresh=None) -> pa.RecordBatch:
    fresh = np.full(len(node), FORWARD | REVERSE) if fresh is None else fresh
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(sim, pa.float32()),
                                       pa.array(fresh, pa.int32())], ["node", "nbr", "sim", "fresh"])


def leaf_edges(nodes: DataFrame, count: int, size: int, degree: int, buckets: int, seed: int = 1) -> DataFrame:
    """Packed edges by brute force inside the leaves of random hyperplane trees."""
    bits = max(0, int(np.ceil(np.log2(max(1, count) / (LEAF / 2)))))
    planes = np.random.default_rng(seed).normal(size=(TREES, bits, size)).astype(np.float32)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            for t in range(TREES):
                side = (x @ planes[t].T > 0).astype(np.int64) @ (1 << np.arange(bits)) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(side * TREES + t), batch.column(0), batch.column(1)],
                                                 ["leaf", "node", "vec"])

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches, cells=8 * LEAF):
            node, x = table.column("node").to_numpy(), _matrix(table.column("vec"))
            out = []
            for a, b in zip(start, np.append(start[1:], len(node))):
                if b - a < 2:
                    continue
                sim = x[a:b] @ x[a:b].T
                np.fill_diagonal(sim, -np.inf)
                k = min(degree, b - a - 1)
                at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                out.append((np.repeat(node[a:b], k), node[a:b][at].ravel(), np.take_along_axis(sim, at, 1).ravel()))
            if out:
                node, nbr, sim = (np.concatenate(c) for c in zip(*out))
                yield from edge_rows(node, nbr, sim, np.full(len(node), FORWARD | REVERSE), buckets)

    coded = nodes.mapInArrow(code, "leaf long, node long, vec binary")
    sizes = coded.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF).alias("pieces"))
    dealt = coded.join(sizes, "leaf").withColumn("piece", F.pmod(F.xxhash64("node", "leaf"), F.col("pieces")))
    dealt = dealt.select(F.xxhash64("leaf", "piece").alias("leaf"), "node", "vec")
    return dealt.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(brute, ROW)


def sampled(edges: DataFrame, turn: int) -> DataFrame:
    """hub, node, side, fresh (0/1): what each node introduces in a round, a sample, by the order of a
    hash, of its new and old neighbours in each direction."""
    def end(mine: str, other: str, side: int):
        return F.struct(F.col(mine).alias("hub"), F.col(other).alias("node"), F.lit(side).alias("side"),
                        (F.col("fresh").bitwiseAND(side) > 0).cast("int").alias("fresh"))

    ends = edges.select(F.inline(F.array(end("node", "nbr", FORWARD), end("nbr", "node", REVERSE))))
    w = Window.partitionBy("hub", "side", "fresh").orderBy(F.xxhash64("node", "hub", F.lit(turn)))
    return ends.repartition("hub").withColumn("r", F.row_number().over(w)).where(F.col("r") <= SAMPLE // 2).drop("r")


def aged(edges: DataFrame, met: DataFrame) -> DataFrame:
    """The edges, no longer new in the directions in which ``met`` introduced them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _edges(*ended(*(batch.column(c).to_numpy() for c in range(3))))
    used = met.where("fresh = 1").select("hub", "node", "side").mapInArrow(run, EDGE)
    return best_edges(edges.unionByName(used), 1 << 30)


def introduced(edges: DataFrame, met: DataFrame, nodes: DataFrame) -> DataFrame:
    """New edges between neighbours of one node (``met``) that are better than what they have, and the rows
    that end the newness of the edges that led to them."""
    worst = edges.groupBy("node").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
    worst = worst.select("node", F.when(F.col("n") >= DEGREE, F.col("worst")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
    met = met.groupBy("hub", "node").agg(F.sum(F.col("side") * F.col("fresh")).cast("int").alias("sides"))
    full = met.join(nodes.join(worst, "node"), "node").select("hub", "node", "sides", "worst", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches, cells=20_000):
            hub, node, x = table.column("hub").to_numpy(), table.column("node").to_numpy(), _matrix(table.column("vec"))
            sides, worst = table.column("sides").to_numpy(), table.column("worst").to_numpy()
            fresh = sides > 0
            out = []
            for a, b in zip(start.tolist(), np.append(start[1:], len(node)).tolist()):
                new = fresh[a:b]
                if b - a < 2 or not new.any():
                    continue
                sim = x[a:b] @ x[a:b].T
                good = (sim > worst[a:b, None]) & (new[:, None] | new[None, :])
                np.fill_diagonal(good, False)
                i, j = np.nonzero(good)
                out.append((node[a + i], node[a + j], sim[i, j]))
            if out:
                yield _edges(*(np.concatenate(c) for c in zip(*out)))
            yield _edges(*ended(hub, node, sides))

    return full.repartition("hub").sortWithinPartitions("hub").mapInArrow(run, EDGE)


def both_ways(edges: DataFrame, degree: int) -> DataFrame:
    """node, nbr: the edges and each node's ``degree`` best reverse ones."""
    w = Window.partitionBy("nbr").orderBy(F.desc("sim"), "node")
    back = edges.withColumn("r", F.row_number().over(w)).where(F.col("r") <= degree)
    return edges.select("node", "nbr").union(back.select("nbr", "node")).distinct()


class Graph:
    """nodes (node, vec with the extra component), members (node, vec_id, vec) and edges (node, nbrs)
    that a search follows."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", degree: int = DEGREE,
                 rounds: int = 30, least_change: float = 0.02):
        spark = rows.sparkSession
        self.folder = Folder(spark, "ann")
        v = self.folder.keep(usable_vectors(rows, id_col, vec_col), "vectors")
        first = v.groupBy("vec").agg(F.min("vec_id").alias("node"))
        top = v.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)), F.max(F.size("vec"))).first()
        largest, size = (top[0] or 0.0), (top[1] or 0)
        self.nodes = self.folder.keep(first.mapInArrow(_extended(largest), "node long, vec binary"), "nodes")
        self.members = self.folder.keep(v.join(first, "vec").select("node", "vec_id", "vec"), "members")
        count = self.nodes.count()
        buckets = bucket_count(count, spark.sparkContext.defaultParallelism)
        packed = packed_nodes(self.nodes, buckets, _matrix).unionByName(leaf_edges(self.nodes, count, size + 1, degree, buckets))
        state = self.folder.keep(state_of(packed, degree), "edges")
        for turn in range(rounds if count else 0):
            asked = self.folder.keep(lists(state, turn, buckets, SAMPLE), "asked")
            state = self.folder.keep(state_of(state.unionByName(introduced_packed(state, asked, buckets, degree)), degree), "edges")
            if (state.agg(F.sum("n")).first()[0] or 0) < least_change * degree * count:
                break
        edges = plain_edges(state, EDGE)
        packed = both_ways(edges, degree).groupBy("node").agg(F.collect_list("nbr").alias("nbrs"))
        self.edges = self.folder.keep(packed, "both")

    def longest(self) -> list[int]:
        """The ENTRIES nodes of the longest vectors: by inner product, answers lie around them."""
        norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        first = self.members.where("vec_id = node").select("node", norm.alias("norm"))
        return [r.node for r in first.orderBy(F.desc("norm"), "node").limit(ENTRIES).collect()]

    def search(self, queries: DataFrame, entries: DataFrame, most: int, beam: int = BEAM) -> DataFrame:
        """query_id, node, sim: the ``most`` best nodes found for each query.

        ``queries``: query_id, qvec (packed float32, the extra component 0); ``entries``: query_id, node."""
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    sim = (_matrix(batch.column(2)) * _matrix(batch.column(3))).sum(1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(sim, pa.float32()),
                         pa.array(np.zeros(len(sim), np.int32))], ["query_id", "node", "sim", "expanded"])

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, _ in whole_groups(batches):
                q, node = table.column("query_id").to_numpy(), table.column("node").to_numpy()
                sim, done = table.column("sim").to_numpy(), table.column("expanded").to_numpy()
                order = np.lexsort((-done, node, q))  # a node met again was expanded already
                order = order[~np.append(False, (q[order][1:] == q[order][:-1]) & (node[order][1:] == node[order][:-1]))]
                order = order[np.lexsort((node[order], -sim[order], q[order]))]
                g = q[order]
                order = order[first_of_groups(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g), max(beam, most))]
                yield from table.take(pa.array(order)).combine_chunks().to_batches()

        schema = "query_id long, node long, sim float, expanded int"

        def measured(pairs: DataFrame) -> DataFrame:
            return pairs.join(self.nodes, "node").select("query_id", "node", "qvec", "vec").mapInArrow(measure, schema)

        found = self.folder.keep(measured(entries.join(queries, "query_id")), "found")
        while True:
            open_ = found.where("expanded = 0").select("query_id", "node").join(self.edges, "node")
            steps = open_.select("query_id", F.explode("nbrs").alias("node"), F.lit(False).alias("known"))
            steps = steps.unionByName(found.select("query_id", "node", F.lit(True).alias("known"))).repartition("query_id")
            steps = steps.groupBy("query_id", "node").agg(F.bool_or("known").alias("known")).where("not known")
            grown = found.withColumn("expanded", F.lit(1)).unionByName(measured(steps.join(queries, "query_id")))
            found = self.folder.keep(grown.repartition("query_id").sortWithinPartitions("query_id")
                                     .mapInArrow(keep, schema), "found")
            if found.where("expanded = 0").isEmpty():
                return found


def _extended(largest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(0).to_numpy(zero_copy_only=False))
                extra = np.sqrt(np.maximum(largest - (x * x).sum(1), 0.0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), _binary_rows(np.column_stack([x, extra]).astype(np.float32))], ["node", "vec"])
    return run


def neighbours_of_rows(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found other rows of each row where ``is_query``
    (a condition on ``vec_id``) holds; the search starts at the query's own node and the longest."""
    g = Graph(rows, id_col, vec_col)
    own = g.members.where(is_query)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _binary_rows(np.column_stack([x, np.zeros(len(x))]).astype(np.float32))],
                    ["query_id", "qvec"])

    queries = g.folder.keep(own.select("vec_id", "vec").mapInArrow(pack, "query_id long, qvec binary"), "queries")
    start = own.select(F.col("vec_id").alias("query_id"), F.explode(F.array_distinct(F.concat(
        F.array("node"), F.lit(g.longest()).cast("array<long>")))).alias("node"))
    found = g.search(queries, start, k + 1)
    # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
    w = Window.partitionBy("node").orderBy("vec_id")
    few = g.members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).drop("r")
    pairs = (found.select("query_id", "node").join(few, "node").where("vec_id <> query_id")
             .join(own.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("qvec")), "query_id")
             .select("query_id", "vec_id", "qvec", "vec"))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)) for c in (2, 3))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a * b).sum(1))],
                                                 ["query_id", "vec_id", "score"])

    scored = pairs.mapInArrow(exact, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
