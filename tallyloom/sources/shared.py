"""Shared storage for lineage cuts, snapshots and streaming state.

Everything is written under the folder the cluster names in
``spark.checkpoint.dir``, so any executor can read it and losing one executor
loses nothing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this application, set up only where the session has none."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tallyloom-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later plans share one fixed copy of it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
