"""Session helpers: a local session for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "servicelens") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SERVICELENS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taken from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is
    only invented here (under the system temp folder) for local sessions.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running ranking jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="servicelens-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder (survives executor loss).

    The frame is persisted first: an eager checkpoint runs one job to compute
    the rows and another to write them, which would otherwise recompute it.
    """
    from pyspark.storagelevel import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out
