"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.shared import shared_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that every later reader sees the same rows."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def modest_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """Bound the rows of an Arrow batch, as texts are long; a session's own setting is left alone."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == "10000":
        df.sparkSession.conf.set(key, str(rows))
    return df


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text (null: empty) alone, so that other columns, whatever their names, cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``texts_of`` with ``th``, a hash of the text.

    (doc_id, th) names a document in joins. Rows equal in both are copies of one
    document and get the same result.
    """
    return texts_of(docs).withColumn("th", F.xxhash64("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed_rows(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_repeats(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of kept rows (``row``, ``keys``, ``copies``), one for each key; ``copies`` > 1 marks keys that several rows share."""
    single = found.where("copies = 1").select("row")
    again = found.where("copies > 1").groupBy(*keys).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return single.unionByName(again)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column without nulls; the bytes are not copied."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
