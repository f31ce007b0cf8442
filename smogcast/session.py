"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "smogcast") -> SparkSession:
    """A session configured the way the library expects.

    AQE stays on so shuffle partitions coalesce and skewed joins split at run
    time; the broadcast threshold is AQE's runtime size check, so derived
    tables are broadcast only when their measured size is small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # call sites of every column expression: two more calls to the JVM for each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when nothing is configured (local tests) do we create a scratch
    folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: reliable checkpoints "
                               "cannot live in a machine-local temporary folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="smogcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df):
    """Cut lineage with a reliable checkpoint without computing ``df`` twice.

    A reliable checkpoint writes the data in a second job after the first
    one; persisting for the duration makes that second job read the cached
    blocks instead of recomputing the plan. The cache is released once the
    checkpoint files exist (recovery then reads the shared folder).
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = df.checkpoint(eager=True)
    finally:
        df.unpersist()
    return out
