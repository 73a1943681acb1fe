"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Stands in for the setting above in local sessions without it, where it can no longer be set.
_FALLBACK_DIR = "spark.tallyspark.staging.dir"


def staging_root(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, else the context's checkpoint folder.

    If there is neither, a session on one machine (``local[...]``, as in tests) gets a new temporary folder. On a cluster
    it is an error, since each executor would write to a disk of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir() or spark.conf.get(_FALLBACK_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tallyspark-")
        spark.conf.set(_FALLBACK_DIR, root)
    return root


def run_folder(spark: SparkSession) -> str:
    """Where everything that this application stores in between lies."""
    return f"{staging_root(spark).rstrip('/')}/tallyspark/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path for a table of this run."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back, so later steps start from files.

    For frames that several later steps read. The files outlive lost executors, unlike a cache.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> bool:
    """Removes all that this application has stored in between; frames read from it can no longer be used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
