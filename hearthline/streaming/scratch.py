"""A shared folder for a job's own files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the cluster names it; a temporary folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='hearthline-')}"


def stash(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows does not compute it again, also after a lost executor."""
    spark = df.sparkSession
    path = f"{folder(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``stash`` wrote, once nothing to come reads it."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
