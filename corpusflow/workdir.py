"""The shared folder a job may leave working tables in."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What the cluster names in ``spark.checkpoint.dir``, or the checkpoint folder
    already set; where there is neither, a temporary folder on a local master, which
    shares its disk with all of its tasks, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusflow-"))
    return spark.sparkContext.getCheckpointDir()


def workspace(spark: SparkSession) -> str:
    """A fresh folder of its own in the shared one."""
    return f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written down, with nothing left to recompute."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
