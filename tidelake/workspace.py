"""The shared folder for intermediate tables, and session settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the session's ``spark.checkpoint.dir`` names it.

    Where it is unset, the context's checkpoint folder serves; on a local master
    a temporary one is set if need be.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidelake-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def local_settings() -> dict[str, str]:
    """For a local master only, as long as the user set nothing else.

    The floor for merging shuffle partitions is low, so that a small backfill of
    many days, whose cost is its number of files, is written in parallel.
    """
    return {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}


def tune(spark: SparkSession) -> SparkSession:
    """Settings the jobs count on; none is a size, and none depends on the cluster.

    ANSI mode makes a malformed value raise where it would silently be NULL.
    The user's shuffle partitions, scan splits and broadcast limit hold.
    """
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
    }
    if spark.sparkContext.master.startswith("local"):
        settings |= {k: v for k, v in local_settings().items() if spark.conf.get(k, None) is None}
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark
