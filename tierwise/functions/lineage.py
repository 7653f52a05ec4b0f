"""Cutting long lineage without depending on any single executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder of this session, as the cluster names it in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tierwise-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
