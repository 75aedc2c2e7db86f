"""Token-id files of byte or bit planes.

A file set is two Parquet tables under one folder. ``chunks`` holds whole
documents' ids in ascending doc_id order: a shard is one range of ids, a chunk
some consecutive documents of it. Within a chunk the ids are cut into blocks of
``block`` ids; each block is transposed, so that the i-th byte (or bit) of all
its ids lies together as plane i, and each plane is compressed with zstandard.
``index`` names, for every block, its first id and the place and size of each
plane. Planes that hold only zeros compress to a few bytes.

Documents are range-partitioned on (doc_id, hash of the text), encoded where
they land and never gathered; a chunk is bounded by ``chunk_ids`` or one document.

Null text counts as empty (its end id alone). Null doc_ids come first; rows that
share a doc_id stand side by side in the order of their hashes. An empty table
gives empty files. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.bpe import byte_bpe, packed
from tallyloom.llm.common import keyed_texts, modest_batches

CHUNK = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<bigint>, doc_lengths array<bigint>,"
    " blocks array<struct<first:bigint,n_ids:int,offsets:array<int>,sizes:array<int>>>, payload binary"
)
_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("first", pa.int64()), ("n_ids", pa.int32()), ("offsets", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))]))), ("payload", pa.binary()),
    ]
)


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of a block of uint32 ids, the least significant first."""
    if kind == "byte":
        return [np.ascontiguousarray(p).tobytes() for p in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return [np.packbits((ids >> np.uint32(b)) & np.uint32(1)).tobytes() for b in range(32)]


def join_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view("<u4").ravel()
    out = np.zeros(n, np.uint32)
    for b, p in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(np.uint32) << np.uint32(b)
    return out


def write_tokens(docs: DataFrame, path: str, vocab: str, end_id: int = 2, block: int = 16_384, chunk_ids: int = 131_072, kind: str = "byte", level: int = 3) -> None:
    """Encode every document, append ``end_id`` and write the files under ``path``."""
    if kind not in ("byte", "bit"):
        raise ValueError("kind is byte or bit")

    def encode(batches):
        import zstandard

        bpe, end, pack = byte_bpe(vocab), packed([end_id]), zstandard.ZstdCompressor(level=level)
        shard, state = TaskContext.get().partitionId(), {"chunk": 0, "first": 0}

        def chunk(doc_ids, parts):
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            blocks, out, at = [], [], 0
            for lo in range(0, len(ids), block):
                planes = [pack.compress(p) for p in split_planes(ids[lo : lo + block], kind)]
                sizes = [len(p) for p in planes]
                offsets = [at + sum(sizes[:i]) for i in range(len(sizes))]
                blocks.append({"first": state["first"] + lo, "n_ids": len(ids[lo : lo + block]), "offsets": offsets, "sizes": sizes})
                out += planes
                at += sum(sizes)
            row = {"shard": shard, "chunk": state["chunk"], "first": state["first"], "n_ids": len(ids), "doc_ids": doc_ids, "doc_lengths": [len(p) // 4 for p in parts], "blocks": blocks, "payload": b"".join(out)}
            state["chunk"] += 1
            state["first"] += len(ids)
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        doc_ids, parts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                parts.append(bpe.encode(text.as_py()) + end)
                size += len(parts[-1]) // 4
                if size >= chunk_ids:
                    yield chunk(doc_ids, parts)
                    doc_ids, parts, size = [], [], 0
        if parts:
            yield chunk(doc_ids, parts)

    texts = keyed_texts(docs)
    ordered = modest_batches(texts.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th"), 500)
    spark = docs.sparkSession
    ordered.select("doc_id", "text").mapInArrow(encode, CHUNK).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks")
    chunks.select("shard", "chunk", F.inline("blocks")).withColumn("kind", F.lit(kind)).write.parquet(f"{path}/index")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, shard, first (ids of the shard before it), n_tokens, ids."""

    def decode(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                kind = "byte" if not row["blocks"] or len(row["blocks"][0]["sizes"]) == 4 else "bit"
                data, ids = row["payload"], []
                for b in row["blocks"]:
                    planes = [unpack.decompress(data[o : o + s]) for o, s in zip(b["offsets"], b["sizes"])]
                    ids.append(join_planes(planes, b["n_ids"], kind).astype("<u4").tobytes())
                ids, at, out = b"".join(ids), 0, []
                for doc_id, n in zip(row["doc_ids"], row["doc_lengths"]):
                    out.append({"doc_id": doc_id, "shard": row["shard"], "first": row["first"] + at, "n_tokens": n, "ids": ids[4 * at : 4 * (at + n)]})
                    at += n
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]))

    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks")
    return chunks.mapInArrow(decode, "doc_id long, shard int, first long, n_tokens long, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: shard, base (ids in all shards before it), from the index alone."""
    shards = spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
