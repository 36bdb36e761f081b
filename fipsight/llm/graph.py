"""Connected components as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.store import Folder


def components(links: DataFrame, folder: Folder) -> DataFrame:
    """node, label (the least node of its component) of all nodes of the links (u, v).

    Alternating large-star and small-star rounds: every node hands its larger, then its smaller
    neighbours to the least node it sees. Neighbours are never gathered; a node of many links is a
    minimum with partial sums and a join that adaptive execution can split. Ends when a round
    changes no link; a long chain takes a number of rounds of the order of its logarithm.
    """
    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = least(both).select("u", F.least("u", "m").alias("m"))
        edges = both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = least(edges)
        moved = edges.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = moved.unionByName(m.select("u", F.col("m").alias("v"))).distinct()
        edges = folder.keep(edges, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(roots.select("node", F.col("node").alias("label"))))
