"""Folders for data that must outlive a task: stream checkpoints and derived tables.

On a cluster the folder comes from ``spark.checkpoint.dir``, which has to be shared storage.  Only
a local session that names none gets a temporary folder of its own.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the checkpoint folder; nothing is created there yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new path and read back: computed once, and kept if an executor is lost.

    Other than a checkpoint this computes it no second time, and its true size is known to the
    planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
