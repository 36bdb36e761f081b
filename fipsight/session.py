"""Session helpers for tests and the benchmark (library code never builds a session)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "fipsight", shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session tuned for small test data; UI off, AQE on, UTC clock."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared (HDFS/object-store) path and it is only read
    here. Where it is unset, a local session (one machine, as in tests) takes a fresh temporary
    folder; a cluster raises, since executors do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fipsight-ckpt-")
        try:  # only records the choice; some deployments reject runtime core settings
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
