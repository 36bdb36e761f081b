"""Merkle dataset manifest: leaves, subtrees, root and inclusion proofs by lag and lead windows.

A document's leaf is H (lowercase hex sha256) of its fields, each ``-`` if null, else its UTF-8 byte
count, ``:`` and its value. A tree over nodes in a fixed order makes every FANOUT consecutive nodes (the
last run: what is left, even one) the H of their concatenated digests, until one node remains. Each
source is a tree over its leaves by ascending doc_id; the sources' roots (null source first, then
bytewise) are the nodes of the tree that gives the dataset's root.

Nodes are numbered inside their tree without gathering it: rows are range-partitioned and sorted by
(tree, order), and counts of (partition, tree) give the offsets. A tree of any size is then built block
by block: FANOUT^LEVELS consecutive nodes are closed under LEVELS levels, so the windows are partitioned
by (tree, block), and a source that holds a third of all rows is many small window groups. On level l the
digests stand in the rows whose place is a multiple of FANOUT^l (the first leaf below a node), and

* lag and lead columns with the fixed offsets FANOUT^l and 2 FANOUT^l hold the neighbours of a node,
* masks by the node's slot in its run and by the run's length leave its siblings,
* rows with slot 0 (first children) hash the run: the digests of level l + 1,
* a running ``last`` gives every leaf the siblings of its node.

The blocks' top nodes are the next round's nodes (written to the shared folder); their siblings and tops
come back to the leaves by a join on (tree, block), of at most FANOUT^LEVELS rows a key.

Cases: null fields are ``-`` (not the same as empty); a null source is a tree of its own, before the
empty source; a null doc_id comes first in its source and is never tampered with; rows of one doc_id are
ordered by their leaves, repeated rows are leaves each; very long texts are hashed in their row and
never shuffled; a tree of one leaf is that leaf, its proof is H of nothing; empty table = no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fipsight.llm.store import Folder

FANOUT = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_rows(docs: DataFrame, tampered_text: Column | None = None, tampered: Column | None = None) -> DataFrame:
    """doc_id, tree, leaf, tampered_leaf of every row. ``tampered_text`` replaces the text of the rows
    that meet ``tampered``; ``tree`` orders the sources (null first) and names them without a null."""
    names = [F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS]
    rows = docs.select(*names)
    fields = [field(F.col(c)) for c in FIELDS]
    leaf = digest(*fields)
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col("source")))
    if tampered_text is None:
        other = F.lit(None).cast("string")
    else:
        changed = digest(*fields[:-1], field(tampered_text))
        other = F.when(tampered & ~tampered_text.eqNullSafe(F.col("text")), changed)
    return rows.select("doc_id", tree.alias("tree"), leaf.alias("leaf"), other.alias("tampered_leaf"))


def numbered(rows: DataFrame, order: list[str], folder: Folder, name: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, in its tree) and ``size`` (nodes of the tree).

    The sorted rows are written once; a row's number inside its (file partition, tree) comes from the
    sorted partition, the offset from the counts of the partitions before."""
    s = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    s = folder.keep(s.withColumn("part", F.spark_partition_id()).withColumn("number", F.monotonically_increasing_id()),
                    f"{name}-sorted")
    counts = s.groupBy("tree", "part").agg(F.count("*").alias("c"), F.min("number").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tree", "part", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"),
                            F.sum("c").over(Window.partitionBy("tree")).alias("size"))
    return (s.join(offsets, ["tree", "part"])
            .withColumn("place", F.col("offset") + F.col("number") - F.col("first"))
            .drop("part", "number", "first", "offset"))


def in_blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (tree, place, size, digest, ...) with block, top (digest of the block's last level) and
    steps: for each level inside the block the digests left and right of the row's node in its run."""
    span = FANOUT ** levels
    rows = nodes.withColumn("block", F.floor(F.col("place") / span)).withColumn("d0", F.col("digest"))
    w = Window.partitionBy("tree", "block").orderBy("place")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place, steps = F.col("place"), []
    for level in range(levels):
        wide = FANOUT ** level
        number = F.floor(place / wide)  # of the node in its level
        count = F.ceil(F.col("size") / wide)  # nodes of the level in the whole tree
        slot = F.pmod(number, F.lit(FANOUT))
        run = F.least(F.lit(FANOUT), count - (number - slot))  # nodes in this run
        open_ = count > 1  # else the tree has ended
        node = F.pmod(place, F.lit(wide)) == 0
        d = f"d{level}"
        rows = rows.withColumns({f"lag{k}": F.lag(d, k * wide).over(w) for k in range(1, FANOUT)} |
                                {f"lead{k}": F.lead(d, k * wide).over(w) for k in range(1, FANOUT)})
        none = F.lit("")
        left = F.concat(*[F.when(slot >= k, F.col(f"lag{k}")).otherwise(none) for k in range(FANOUT - 1, 0, -1)])
        right = F.concat(*[F.when(slot + k < run, F.col(f"lead{k}")).otherwise(none) for k in range(1, FANOUT)])
        first = node & (slot == 0)
        rows = rows.withColumns({
            f"s{level}": F.when(node & open_, F.struct(left.alias("left"), right.alias("right"))),
            f"d{level + 1}": F.when(first, F.when(open_, digest(F.col(d), right)).otherwise(F.col(d)))})
        rows = rows.drop(*[f"{x}{k}" for x in ("lag", "lead") for k in range(1, FANOUT)])
        steps.append(F.last(f"s{level}", ignorenulls=True).over(running))
    rows = rows.withColumns({f"t{k}": c for k, c in enumerate(steps)} |
                            {"top": F.first(f"d{levels}").over(running)})
    made = F.filter(F.array(*[F.col(f"t{k}") for k in range(levels)]), lambda s: s.isNotNull())
    return rows.withColumn("steps", made).drop(*[f"{x}{k}" for x in "ds" for k in range(levels + 1)],
                                               *[f"t{k}" for k in range(levels)])


def climb(nodes: DataFrame, folder: Folder, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``nodes`` (tree, place, size, digest, other columns) with steps (all levels up to the root of the
    tree) and top (that root). One round for LEVELS levels of the largest tree. ``finish`` gets the last
    round's rows, at most FANOUT^LEVELS of each tree, and gives them columns (tree's steps, root) that go
    down to all nodes."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels = next((k for k in range(1, LEVELS) if FANOUT ** k >= largest), LEVELS)
    span = FANOUT ** levels
    rows = folder.keep(in_blocks(nodes, levels), "blocks")
    if largest <= span:
        rows = rows.drop("block")
        return folder.keep(finish(rows), "finished") if finish else rows
    tops = rows.where(F.pmod("place", F.lit(span)) == 0).select(
        "tree", F.col("block").alias("place"), F.ceil(F.col("size") / span).alias("size"), F.col("top").alias("digest"))
    above = climb(tops, folder, finish).drop("size", "digest")
    above = above.withColumnsRenamed({"place": "block", "steps": "more"})
    rows = rows.drop("top").join(above, ["tree", "block"])
    return rows.withColumn("steps", F.concat("steps", "more")).drop("block", "more")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda d, s: digest(s["left"], d, s["right"]))


def proof(steps: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered_leaf, subroot, root and steps (siblings left and right on each level, by
    the subroot to the root) of every row of ``leaf_rows``."""
    folder = Folder(leaves.sparkSession, "merkle")

    def to_root(rows: DataFrame) -> DataFrame:
        sources = rows.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("source"),
                                                 F.col("top").alias("digest"))
        roots = climb(numbered(folder.keep(sources, "sources"), ["source"], folder, "sources"), folder)
        above = roots.select(F.col("source").alias("tree"), F.col("steps").alias("rest"), F.col("top").alias("root"))
        return rows.join(above, "tree").withColumn("steps", F.concat("steps", "rest")).drop("rest")

    rows = folder.keep(leaves.withColumnRenamed("leaf", "digest"), "leaves")
    rows = climb(numbered(rows, ["doc_id", "digest"], folder, "leaves"), folder, to_root)
    return rows.select("doc_id", F.col("digest").alias("leaf"), "tampered_leaf", F.col("top").alias("subroot"), "root",
                       "steps")


def verify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: each document's proof, folded
    from its leaf as it would be if the line breaks of the documents with an even crc32 of the id's
    decimal text had been deleted."""
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    rows = manifest(leaf_rows(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), even))
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered_leaf", "leaf"), F.col("steps")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
