"""Versioned tables: a folder for every snapshot and a log that names them.

A write adds a folder and never touches an older one, so a reader of any
version is undisturbed, publishing is one more snapshot, and rolling back is
reading or republishing the previous one. Which folder holds the table as of a time
is read from the commit log alone; no data folder is listed for it. Two writers
of the same version conflict, and the log takes the first.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.commits import commit, entries, new_folder, next_version


def write_snapshot(df: DataFrame, root: str, at: str) -> None:
    """Store ``df`` as the version of time ``at``; of several of one time the last counts."""
    spark, folder = df.sparkSession, new_folder()
    version = next_version(entries(spark, root))
    df.write.parquet(f"{root}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()
    commit(spark, root, version, folder, rows=rows, kind="snapshot", at=at)


def read_as_of(spark: SparkSession, root: str, at: str | None = None, offset_seconds: int | None = None) -> DataFrame:
    """The newest version not later than ``at``, or ``offset_seconds`` before the newest one."""
    versions = [(datetime.fromisoformat(e.at), e.version, e.folder) for e in entries(spark, root)]
    newest = max((t for t, _, _ in versions), default=None)
    limit = datetime.fromisoformat(at) if at else newest
    if offset_seconds is not None and newest:
        limit = newest - timedelta(seconds=offset_seconds)
    chosen = max((v for v in versions if v[0] <= limit), default=None)
    if chosen is None:
        raise LookupError(f"no snapshot at or before {at}")
    return spark.read.parquet(f"{root}/{chosen[2]}")


def publish(spark: SparkSession, root: str, staging: DataFrame, at: str) -> DataFrame:
    """Cut over to ``staging``: it becomes the newest version, the old one stays readable."""
    write_snapshot(staging, root, at)
    return read_as_of(spark, root)
