"""Filter interaction audit: what every order of a set of document filters removes, by decision diagrams.

1. Failure masks. Each document gets one bit for each filter that it fails, and the documents are
   counted by (part, mask): at most 2^k rows for each part, from partial sums. The filter for exact
   copies needs the least doc_id of each text: rows are first reduced to counts by (text digest,
   part, mask, labels), so a text that a third of all rows share is a few rows when its copies meet.
2. Diagrams. Each part's counts become an ordered decision diagram: one level for each filter, a low
   edge (passes) and a high edge (fails), nodes of equal counts shared, and every node weighted by the
   documents below it. One diagram serves all k! orders: neighbouring orders differ by one swap of two
   adjacent filters, which rebuilds the nodes of two levels and leaves the others alone.
3. Steps. The all-pass path (low edges from the root) of an order gives its steps: the weight of a
   node's low child is what is kept, that of its high child what is removed.

Cases: a null text is empty; a null part is the empty string and counts with it; a null doc_id is
never a copy and has no labels; rows of one doc_id with the same text are not copies of each other;
an id labelled more than once has every label that one of its rows gives; a null failure condition
is a pass; repeated rows count each; very long texts cost memory in proportion; empty table = no
rows; extra columns are ignored, whatever their names. The number of filters is at most MOST_FILTERS,
since the result holds k * k! rows for each part.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_FILTERS = 8
SPACES = " \t\n\x0b\x0c\r"
WEIGHTS = ("n", "good", "toxic")


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, text, n_words, n_distinct, n_capitals, n_points of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    trimmed = F.btrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>"))
                           .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")))
    return rows.select("doc_id", "part", "text", F.size("words").alias("n_words"),
                       F.size(F.array_distinct("words")).alias("n_distinct"),
                       F.regexp_count("text", F.lit("[A-Z]")).alias("n_capitals"), F.char_length("text").alias("n_points"))


def text_filters() -> dict[str, Column]:
    """Failure conditions on the columns of ``text_measures``."""
    return {"A": F.col("n_words") < 200,
            "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 3 * F.col("n_points"),
            "D": F.col("text").rlike("[#$%&*|]")}


def label_flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, good, toxic: one row for each labelled id."""
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
            .agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
                 F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")))


def mask_counts(measured: DataFrame, flags: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """part, mask, n, good, toxic. Bit i of ``mask`` is the i-th condition; the bit behind them all is
    that of the copies (a text that a smaller doc_id has too)."""
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    copy_bit = 1 << len(conditions)
    rows = measured.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    # rows without an id match no label; their digest as the key deals them out
    rows = rows.withColumn("id_key", F.coalesce(F.col("doc_id").cast("string"), F.hex("digest")))
    flagged = flags.select(F.col("doc_id").cast("string").alias("id_key"), "good", "toxic")
    rows = rows.join(flagged, "id_key", "left").fillna(False, ["good", "toxic"])
    text = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy("doc_id", *text).agg(F.count("*").alias("c"))
    no_id = F.col("doc_id").isNull()
    by_text = by_id.groupBy(*text).agg(
        F.sum("c").alias("n"), F.sum(F.when(no_id, F.col("c")).otherwise(0)).alias("without_id"),
        F.min(F.when(~no_id, F.struct("doc_id", "c"))).alias("first"))
    by_text = by_text.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest")))
    originals = F.col("without_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.c")).otherwise(0)
    split = by_text.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), (F.col("n") - originals).alias("n")))).alias("x"))
    return (split.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask"))
            .agg(F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic")))


class Diagram:
    """Ordered decision diagram of weighted counts over k binary variables.

    A node of level i is a list [low, high, weight]; level k holds the leaves, one for each distinct
    weight. Nodes of a level with the same children are one node. A weight is a tuple of counts: the
    sum over the assignments below the node.
    """

    def __init__(self, counts: Mapping[int, tuple], k: int, size: int):
        self.order = list(range(k))
        self.leaves: dict = {}
        self.levels: list[dict] = [{} for _ in range(k)]
        zero = (0,) * size

        def build(level: int, mask: int) -> list:
            if level == k:
                return self._leaf(counts.get(mask, zero))
            return self._node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _leaf(self, weight: tuple) -> list:
        return self.leaves.setdefault(weight, [None, None, weight])

    def _node(self, level: int, low: list, high: list) -> list:
        known = self.levels[level]
        at = (id(low), id(high))
        if at not in known:
            known[at] = [low, high, tuple(a + b for a, b in zip(low[2], high[2]))]
        return known[at]

    def swap(self, i: int) -> None:
        """Exchange the variables of levels i and i + 1. A node of level i keeps its place, so
        whatever points to it stays as it is; the level below is built anew."""
        upper = list(self.levels[i].values())
        self.levels[i], self.levels[i + 1] = {}, {}
        for node in upper:
            (a, b, _), (c, d, _) = node[0], node[1]
            node[0], node[1] = self._node(i + 1, a, c), self._node(i + 1, b, d)
            self.levels[i][id(node[0]), id(node[1])] = node
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def failing(self) -> dict[int, tuple]:
        """Weight of all assignments that fail each variable."""
        out, paths = {}, {id(self.root): (self.root, 1)}
        for variable in self.order:
            below: dict = {}
            total = (0,) * len(self.root[2])
            for node, times in paths.values():
                total = tuple(t + times * w for t, w in zip(total, node[1][2]))
                for child in node[:2]:
                    below[id(child)] = (child, below.get(id(child), (child, 0))[1] + times)
            out[variable], paths = total, below
        return out

    def path(self) -> Iterator[tuple]:
        """(variable, kept, removed, failing this variable only) along the all-pass path."""
        node = self.root
        for variable in self.order:
            only = node[1]
            while only[0] is not None:
                only = only[0]
            yield variable, node[0][2], node[1][2], only[2]
            node = node[0]


def adjacent_swaps(k: int) -> Iterator[int]:
    """Places i whose swaps (i, i + 1), one after the other, run through all k! orders, each once."""
    if k < 2:
        return
    place, step = k - 1, -1  # of the last variable, which sweeps from end to end
    inner = adjacent_swaps(k - 1)
    while True:
        while 0 <= place + step < k:
            yield min(place, place + step)
            place += step
        i = next(inner, None)
        if i is None:
            return
        yield i + (1 if place == 0 else 0)
        step = -step


def audit_rows(counts: Mapping[int, tuple], names: list[str]) -> list[dict]:
    """The steps of all orders of one part, from its (n, good, toxic) by failure mask."""
    k = len(names)
    diagram = Diagram(counts, k, len(WEIGHTS))
    failing = diagram.failing()
    rows: list[dict] = []
    shapley = [0] * k

    def steps() -> None:
        order = "".join(names[v] for v in diagram.order)
        for step, (v, kept, removed, only) in enumerate(diagram.path(), 1):
            shapley[v] += removed[0]
            rows.append({"filter_order": order, "step": step, "kept": kept[0], "removed": removed[0],
                         "redundant": failing[v][0] - removed[0], "unique_fails": only[0], "good_lost": removed[1],
                         "toxic_lost": removed[2], "shapley": v})

    steps()
    for i in adjacent_swaps(k):
        diagram.swap(i)
        steps()
    for r in rows:
        r["shapley"] = shapley[r["shapley"]]
    return rows


def audit(masks: DataFrame, names: list[str]) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley:
    every step of every order of the filters ``names`` (one-letter names, bit i of the mask each)."""
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    schema = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
              "good_lost long, toxic_lost long, shapley long")
    kinds = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] +
                      [(c.split()[0], pa.int64()) for c in schema.split(", ")[3:]])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        counts = {r["mask"]: tuple(r[w] for w in WEIGHTS) for r in table.to_pylist()}
        rows = audit_rows(counts, names)
        return pa.Table.from_pylist([{"part": key[0].as_py(), **r} for r in rows], kinds)

    return masks.groupBy("part").applyInArrow(run, schema)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of this module (``text_filters`` and E, exact copies)."""
    conditions = text_filters()
    masks = mask_counts(text_measures(docs), label_flags(labels), conditions)
    return audit(masks, [*conditions, "E"])
