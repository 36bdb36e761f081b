"""Rounds of NN-descent over packed tables: nodes are dealt to buckets, and rows between them hold arrays.

The rules are those of ``ann.sampled``, ``ann.introduced`` and ``ann.best_edges``, which do the same with a row an
edge; here a round's four shuffles carry one row for each pair of buckets, and a bucket asks for a vector once,
however many of its hubs introduce it. A bucket is about ``PER`` nodes, so a task's memory does not grow with the data.

Rows: bucket, kind, n (new edges, in a state), a to d. VEC: nodes, vectors. EDGE: node, nbr, sim, fresh. SIDE: hub,
member, its side, fresh. LIST: hub, member, its sides in which it is new. ASK: members, the asking bucket.
ANSWER: members, vectors, the least sim of each one's full list. A state is the VEC and EDGE rows of all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.groups import first_of_groups

PER = 4096
VEC, EDGE, SIDE, LIST, ASK, ANSWER = range(6)
FORWARD, REVERSE = 1, 2
ROW = "bucket int, kind int, n long, a binary, b binary, c binary, d binary"
_NAMES = ["bucket", "kind", "n", "a", "b", "c", "d"]
_EDGE = (np.int64, np.int64, np.float32, np.uint8)


def best(node, nbr, sim, fresh, most: int) -> tuple[np.ndarray, ...]:
    """The ``most`` best (sim, then smaller nbr) edges of each node; a repeated edge is new in the directions
    in which all its rows are."""
    if not len(node):
        return node, nbr, sim, fresh
    order = np.lexsort((nbr, node))
    node, nbr = node[order], nbr[order]
    at = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (nbr[1:] != nbr[:-1])))
    node, nbr = node[at], nbr[at]
    sim, fresh = np.maximum.reduceat(sim[order], at), np.bitwise_and.reduceat(fresh[order], at)
    new = np.append(True, node[1:] != node[:-1])
    order = np.lexsort((-sim, np.cumsum(new)))  # stable: then by nbr
    order = order[first_of_groups(np.flatnonzero(new), len(node), most)]
    return node[order], nbr[order], sim[order], fresh[order]


def ended(hub, node, sides) -> tuple:
    """Rows node, nbr, sim, fresh that end the newness of edges in the directions ``sides`` (bits) in which
    they were introduced at ``hub``; they are no edges of their own."""
    ahead, back = (sides & FORWARD) > 0, (sides & REVERSE) > 0
    return (np.concatenate([hub[ahead], node[back]]), np.concatenate([node[ahead], hub[back]]),
            np.full(ahead.sum() + back.sum(), -np.inf, np.float32),
            np.repeat([REVERSE, FORWARD], [ahead.sum(), back.sum()]))


def bucket_count(nodes: int, parallel: int) -> int:
    return max(1, -(-nodes // PER), min(parallel, nodes // 256))


def bucket_of(ids: np.ndarray, count: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(count)).astype(np.int32)


def _row(bucket: int, kind: int, *arrays, n: int = 0) -> pa.RecordBatch:
    blobs = [np.ascontiguousarray(x).tobytes() for x in arrays] + [None] * (4 - len(arrays))
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([n], pa.int64()),
                                       *[pa.array([x], pa.binary()) for x in blobs]], _NAMES)


def dealt(by: np.ndarray, count: int, kind: int, *arrays) -> Iterator[pa.RecordBatch]:
    """One row for each bucket of the nodes ``by``."""
    bucket = bucket_of(by, count)
    order = np.argsort(bucket, kind="stable")
    end = np.cumsum(np.bincount(bucket, minlength=count))
    for b in np.unique(bucket).tolist():
        mine = order[end[b - 1] if b else 0:end[b]]
        yield _row(b, kind, *(x[mine] for x in arrays))


def edge_rows(node, nbr, sim, fresh, count: int) -> Iterator[pa.RecordBatch]:
    yield from dealt(node, count, EDGE, *(np.asarray(x, t) for x, t in zip((node, nbr, sim, fresh), _EDGE)))


class _Bucket:
    """All rows of a bucket."""

    def __init__(self, number: int):
        self.number, self.rows = number, {}

    def add(self, kind: int, blobs: list) -> None:
        self.rows.setdefault(kind, []).append(blobs)

    def arrays(self, kind: int, *types) -> list[np.ndarray]:
        rows = self.rows.get(kind, [])
        return [np.concatenate([np.frombuffer(r[i], t) for r in rows]) if rows else np.zeros(0, t) for i, t in enumerate(types)]

    def vectors(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted nodes and their vectors."""
        nodes, flat = self.arrays(kind, np.int64, np.float32)
        order = np.argsort(nodes, kind="stable")
        return nodes[order], flat.reshape(len(nodes), -1)[order] if len(nodes) else flat.reshape(0, 1)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[_Bucket]:
    held = None
    for batch in batches:
        number, kind = (batch.column(c).to_pylist() for c in range(2))
        for i, b in enumerate(number):
            if held is None or held.number != b:
                if held is not None:
                    yield held
                held = _Bucket(b)
            held.add(kind[i], [s.as_buffer() if (s := batch.column(c)[i]).is_valid else None for c in range(3, 7)])
    if held is not None:
        yield held


def each_bucket(rows: DataFrame, fn) -> DataFrame:
    """``fn`` of every bucket's rows, which meet in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            yield from fn(bucket)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ROW)


def state_of(rows: DataFrame, degree: int) -> DataFrame:
    """VEC and EDGE rows merged: one VEC row and one EDGE row a bucket, with the best edges of each node."""
    def merge(bucket: _Bucket) -> Iterator[pa.RecordBatch]:
        nodes, vec = bucket.vectors(VEC)
        edges = best(*bucket.arrays(EDGE, *_EDGE), degree)
        yield _row(bucket.number, VEC, nodes, vec)
        yield _row(bucket.number, EDGE, *edges, n=int((edges[3] > 0).sum()))
    return each_bucket(rows, merge)


def packed_nodes(nodes: DataFrame, count: int, matrix) -> DataFrame:
    """VEC rows of (node, vec)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy()
                yield from dealt(ids, count, VEC, ids, matrix(batch.column(1)))
    return nodes.mapInArrow(run, ROW)


def lists(state: DataFrame, turn: int, count: int, sample: int) -> DataFrame:
    """LIST rows, what each hub introduces in a round, a sample of its new and old neighbours in each direction,
    and ASK rows for their vectors. Hubs without a new one have nothing to introduce."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            node, nbr, _, fresh = bucket.arrays(EDGE, *_EDGE)
            if len(node):
                yield _row(bucket.number, SIDE, node, nbr, np.full(len(node), FORWARD, np.uint8), fresh & FORWARD)
                yield from dealt(nbr, count, SIDE, nbr, node, np.full(len(node), REVERSE, np.uint8), (fresh & REVERSE) // REVERSE)

    def draw(bucket: _Bucket) -> Iterator[pa.RecordBatch]:
        hub, member, side, fresh = bucket.arrays(SIDE, np.int64, np.int64, np.uint8, np.uint8)
        mix = (member.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + hub.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
               + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
        mix = (mix ^ (mix >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        group = np.unique(hub, return_inverse=True)[1] * 4 + side // REVERSE * 2 + fresh
        # one number: the group, then the first bits of the hash
        order = np.argsort(group.astype(np.uint64) << np.uint64(40) | (mix ^ (mix >> np.uint64(32))) >> np.uint64(24))
        g = group[order]
        order = order[first_of_groups(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g), sample // 2)]
        order = order[np.lexsort((member[order], hub[order]))]
        hub, member, sides = hub[order], member[order], (side * fresh)[order]
        at = np.flatnonzero(np.append(True, (hub[1:] != hub[:-1]) | (member[1:] != member[:-1])))
        hub, member, sides = hub[at], member[at], np.bitwise_or.reduceat(sides, at)
        start = np.flatnonzero(np.append(True, hub[1:] != hub[:-1]))
        new = np.repeat(np.maximum.reduceat(sides, start) > 0, np.diff(np.append(start, len(hub))))
        hub, member, sides = hub[new], member[new], sides[new]
        if len(hub):
            yield _row(bucket.number, LIST, hub, member, sides)
            asked = np.unique(member)
            for batch in dealt(asked, count, ASK, asked):
                yield batch.set_column(4, "b", pa.array([np.int32(bucket.number).tobytes()], pa.binary()))

    return each_bucket(state.where(F.col("kind") == EDGE).mapInArrow(told, ROW), draw)


def introduced(state: DataFrame, asked: DataFrame, count: int, degree: int) -> DataFrame:
    """EDGE rows: edges between members of one hub that are better than what they have, and the rows that end
    the newness of the edges that led to them. ``asked``: the LIST and ASK rows."""
    def answer(bucket: _Bucket) -> Iterator[pa.RecordBatch]:
        nodes, vec = bucket.vectors(VEC)
        node, _, sim, _ = bucket.arrays(EDGE, *_EDGE)
        worst = np.full(len(nodes), -np.inf, np.float32)
        start = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        if len(start):
            full = np.diff(np.append(start, len(node))) >= degree
            worst[np.searchsorted(nodes, node[start[full]])] = np.minimum.reduceat(sim, start)[full]
        for members, asker, *_ in bucket.rows.get(ASK, []):
            members = np.frombuffer(members, np.int64)
            at = np.searchsorted(nodes, members)
            yield _row(int(np.frombuffer(asker, np.int32)[0]), ANSWER, members, vec[at], worst[at])

    def introduce(bucket: _Bucket) -> Iterator[pa.RecordBatch]:
        hub, member, sides = bucket.arrays(LIST, np.int64, np.int64, np.uint8)
        if not len(hub):
            return
        known, vec = bucket.vectors(ANSWER)
        nodes, _, least = bucket.arrays(ANSWER, np.int64, np.float32, np.float32)
        least = least[np.argsort(nodes, kind="stable")]
        at = np.searchsorted(known, member)
        worst, fresh = least[at], sides > 0
        start = np.flatnonzero(np.append(True, hub[1:] != hub[:-1]))
        out = [ended(hub, member, sides)]
        for a, b in zip(start.tolist(), np.append(start[1:], len(hub)).tolist()):
            new = np.flatnonzero(fresh[a:b])
            x = vec[at[a:b]]
            sim = x[new] @ x.T
            sim[np.arange(len(new)), new] = -np.inf
            w = worst[a:b]
            i, j = np.nonzero(sim > w[new][:, None])
            old = np.where(fresh[a:b], np.inf, w)  # two new members meet from both sides
            p, q = np.nonzero(sim > old[None, :])
            out.append((np.concatenate([member[a + new[i]], member[a + q]]), np.concatenate([member[a + j], member[a + new[p]]]),
                        np.concatenate([sim[i, j], sim[p, q]]), np.full(len(i) + len(p), FORWARD | REVERSE)))
        yield from edge_rows(*(np.concatenate(c) for c in zip(*out)), count)

    answers = each_bucket(state.unionByName(asked.where(F.col("kind") == ASK)), answer)
    return each_bucket(answers.unionByName(asked.where(F.col("kind") == LIST)), introduce)


def plain_edges(state: DataFrame, schema: str) -> DataFrame:
    """A row an edge: node, nbr, sim, fresh."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            node, nbr, sim, fresh = bucket.arrays(EDGE, *_EDGE)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(nbr), pa.array(sim), pa.array(fresh.astype(np.int32))],
                                             ["node", "nbr", "sim", "fresh"])
    return state.where(F.col("kind") == EDGE).mapInArrow(run, schema)
