"""The shared folder: checkpoints and scratch tables that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="clickforge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/clickforge-{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that this process wrote."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``rows`` rows; otherwise leave it alone."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
