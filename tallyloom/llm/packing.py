"""Packing by power-of-two decomposition.

A document of n tokens becomes n // top pieces of ``top`` tokens and one piece
for each bit of the rest, longest first. Every piece is a sequence of its own,
its length a power of two, so no sequence crosses documents and none is padded;
sequences of one length form a bucket from which batches are drawn. Each
document is cut where it lies: there is no shuffle and no group.

Null text counts as empty and gives the end token alone; an empty table gives
no pieces; repeated rows and null doc_ids are packed like any other row; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.bpe import byte_bpe, packed
from tallyloom.llm.common import modest_batches, texts_of

OUT = "doc_id long, start long, length long, doc_tokens long, ids binary"


def piece_lengths(n: int, top: int) -> list[int]:
    rest = n % top
    return [top] * (n // top) + [1 << b for b in range(top.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocab: str, end_id: int = 0, top: int = 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian uint32), bucket, sequence_id, offset.

    ``vocab`` is the path of the tokenizer file on every executor, ``end_id``
    the token put after each document, ``top`` (a power of two) the longest
    sequence. A sequence_id is unique; ``bucket`` is the binary logarithm of the length.
    """
    if top < 1 or top & (top - 1):
        raise ValueError("top must be a power of two")

    def cut(batches):
        bpe, end = byte_bpe(vocab), packed([end_id])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.encode(text.as_py()) + end
                n, at = len(ids) // 4, 0
                for size in piece_lengths(n, top):
                    rows.append((doc_id, at, size, n, ids[4 * at : 4 * (at + size)]))
                    at += size
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    pieces = modest_batches(texts_of(docs)).mapInArrow(cut, OUT)
    return pieces.select(
        "*",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def _batch(rows) -> pa.RecordBatch:
    ids, start, length, n, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.array(start, np.int64)), pa.array(np.array(length, np.int64)), pa.array(np.array(n, np.int64)), pa.array(data, pa.binary())],
        names=["doc_id", "start", "length", "doc_tokens", "ids"],
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences with one folder per length, so that a reader takes whole buckets."""
    pieces.write.partitionBy("bucket").parquet(path)
