"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fipsight.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Folder:
    """A new folder below ``spark.checkpoint.dir`` for the tables of one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, name: str, free: bool = False) -> DataFrame:
        """Write a table and read it back: its lineage ends here. With ``free`` the shuffle files of the
        write are removed when it has ended, since no later job can use them."""
        self.count += 1
        path = f"{self.path}/{self.count}-{name}"
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true" if free else before)
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)


def broadcast_ids(stored: DataFrame, most: int = 2_000_000) -> DataFrame:
    """Mark a stored table of a few integer columns for broadcasting if it has at most ``most`` rows
    (some 30 MB); a larger one is left to a shuffle join."""
    return F.broadcast(stored) if stored.count() <= most else stored
