"""Incremental consumers on Structured Streaming.

The file source's checkpoint holds the position, so each change is used once and
``availableNow`` processes what is there and stops. ``foreachBatch`` may repeat a
batch after a failure; every write below is addressed by its batch id, and is
replaced as a whole or made once, so a repeat changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.changes import merge_dimension
from tallyloom.plans.incremental import USAGE_SUMS, monthly_usage
from tallyloom.sources.lab import daily_usage_of
from tallyloom.sources.keyed import KeyedTable
from tallyloom.sources.shared import cut_lineage


def consume(
    spark: SparkSession, path: str, schema: StructType, checkpoint: str, apply: Callable[[DataFrame, int], None], files_per_batch: int | None = None,
) -> None:
    """Feed every new file's rows to ``apply`` once; empty batches are skipped. ``path`` may be a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def step(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply(batch, batch_id)

    query = reader.parquet(path).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def usage_batch(target: str) -> Callable[[DataFrame, int], None]:
    """Store a batch's monthly sums beside those of earlier batches.

    The stored rows are already aggregated; a month is merged when read, so a
    batch costs its own size and never rewrites the fact.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        monthly_usage(daily_usage_of(batch)).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return apply


def read_usage(spark: SparkSession, target: str) -> DataFrame:
    """The monthly fact: sums over all batches, active users as the latest batch counted them."""
    return spark.read.parquet(target).groupBy("customer_id", "usage_month").agg(
        *[F.sum(c).alias(c) for c in USAGE_SUMS], F.max_by("active_users", "batch_id").alias("active_users")
    )


def dimension_table(spark: SparkSession, target: str, schema: StructType, key: str, surrogate: str, buckets: int = 16) -> KeyedTable:
    """Where a dimension is kept: rows by surrogate, in buckets of the business key."""
    return KeyedTable(spark, target, schema, [surrogate], [key], buckets)


def start_dimension(table: KeyedTable, dim: DataFrame) -> None:
    """Store the first state of a dimension."""
    highest = dim.agg(F.max(table.keys[0])).first()[0]
    table.append(dim, -1, mark=highest or 0)


def dimension_batch(table: KeyedTable, tracked: list[str], at: Column, order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Append the rows that a batch of changes closes or adds; history and untouched keys are neither read nor written.

    A batch of several files can change a key several times; ``order`` names the columns that tell the last change.
    """
    surrogate, key = table.keys[0], table.bucketed[0]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if table.has(batch_id):
            return
        highest = table.mark() or 0
        changed = merge_dimension(table.read(of=batch).filter("is_current"), batch, key, tracked, at, surrogate, order=order, changed_only=True, highest=F.lit(highest))
        changed = cut_lineage(changed)  # surrogates are given once
        last = changed.agg(F.max(surrogate)).first()[0]
        table.append(changed, batch_id, mark=max(highest, last or 0))

    return apply
