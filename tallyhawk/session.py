"""Session helpers: shared scratch space, reliable checkpoints, scoped caching.

Nothing here sets a master, memory sizes or ports; that is the deployment's business.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only under a local master with nothing configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tallyhawk-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other call returns."""
    return f"{shared_folder(spark)}/tallyhawk/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint directory for iterative training; keeps one that is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in shared storage and read it back.

    Later stages restart from the files, so a lost executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "cut")
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for the duration of a ``with`` block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
