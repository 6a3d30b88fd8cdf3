"""Spark session helpers.

The library never builds its own session inside operators: every operator takes
DataFrames and returns DataFrames. These helpers exist for tests, the bench and
the driver entry point, and for the one piece of shared state the iterative
operators need: a *reliable* checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # broadcast only what the planner can prove small; our own broadcasts are
    # explicit and size-checked
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", app: str = "gridloom") -> SparkSession:
    """Session for tests / bench on one machine (local[N])."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("GRIDLOOM_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder and
    is used as is; without it this is an error, since executors and driver share no
    local folder. In local mode (tests) a fresh scratch folder is chosen.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    scratch = tempfile.mkdtemp(prefix="gridloom-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialize to the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and keeps the plans of
    iterative operators (clustering, simplification rounds) from growing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
