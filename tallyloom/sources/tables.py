"""Table reads and writes: scan, copy, append, replace, literal rows, views."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Declared schemas (fixed values): a declared schema spares the footer-reading job of inference
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Copy or materialise a frame (CREATE TABLE AS, truncate-and-reload) and read it back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """INSERT INTO … SELECT: append by column name, then read the whole table."""
    present = df.sparkSession.read.parquet(path)
    df.select(*present.columns).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """INSERT … VALUES and inline VALUES relations."""
    return spark.createDataFrame(list(rows), schema)


def update_where(df: DataFrame, predicate, assignments: dict) -> DataFrame:
    """UPDATE … SET … WHERE; rows where the predicate is NULL stay as they are."""
    return df.withColumns(
        {c: F.when(predicate, v).otherwise(F.col(c)) for c, v in assignments.items()}
    )


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """DELETE … WHERE; rows where the predicate is NULL are kept."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """DELETE … WHERE key IN (subquery)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def insert_if_absent(target: DataFrame, candidates: DataFrame, on: Sequence[str]) -> DataFrame:
    """The candidates whose key the target does not hold yet (append these)."""
    return candidates.join(target.select(*on), list(on), "left_anti")


def union_padded(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a branch lacks are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per named frame."""
    return union_padded(
        *(f.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, f in frames.items())
    )
