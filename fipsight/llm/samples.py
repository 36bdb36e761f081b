"""Training rows: the learning split and a bounded, repeatable sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the id's decimal text modulo ``mod``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def sampled_labels(labels: DataFrame, columns: dict[str, Column], usable: Column, max_rows: int,
                   id_col: str = "doc_id") -> DataFrame:
    """doc_id and the label columns of at most about ``max_rows`` labelled ids, chosen by a hash of
    the id (the same rows on every run, spread over the whole table). An id labelled more than once
    takes the larger label. Rows with a null id or label are left out."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), *[c.alias(n) for n, c in columns.items()])
    known = known.where(usable & F.col("doc_id").isNotNull())
    for n in columns:
        known = known.where(F.col(n).isNotNull())
    total = known.count()
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
                            < int(1_000_000 * max_rows / total))
    return known.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in columns])
