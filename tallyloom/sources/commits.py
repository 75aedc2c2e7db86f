"""A commit log: one small file per version, written only if it is not there yet.

Data folders are written first, under names of their own, and count only once the
log names them; an attempt that dies before its commit leaves nothing behind that
is read. Two writers of one version conflict, and the second one is told so.
Resolving a version reads the log and nothing else.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Row, SparkSession

ENTRY = "version long, folder string, rows long, kind string, at string, batch long, mark long, buckets array<int>"


class Conflict(Exception):
    """Another writer has committed this version."""


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def new_folder() -> str:
    """A folder name that no other attempt has."""
    return f"data/{uuid.uuid4().hex}"


def commit(spark: SparkSession, root: str, version: int, folder: str, **fields) -> None:
    """Make a written folder the given version of the table; raises Conflict if that version exists."""
    system, path = _file_system(spark, f"{root}/log/{version:012d}.json")
    try:
        out = system.create(path, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception.getClass().getName()):
            raise Conflict(f"{root} has a version {version}") from e
        raise
    out.write(bytearray(json.dumps({"version": version, "folder": folder, **fields}).encode()))
    out.close()


def entries(spark: SparkSession, root: str) -> list[Row]:
    """The log in the order of versions, empty for a table that was never written."""
    system, path = _file_system(spark, f"{root}/log")
    if not system.exists(path):
        return []
    return sorted(spark.read.schema(ENTRY).json(f"{root}/log").collect(), key=lambda e: e.version)


def next_version(found: list[Row]) -> int:
    return found[-1].version + 1 if found else 0
