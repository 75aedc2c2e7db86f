"""Registered runs of the streaming consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import day, month_diff
from tallyloom.functions.numbers import dbl
from tallyloom.plans.incremental import MERGED_AT, _dimension, customer_feed
from tallyloom.sources.lab import ORDERS_AS_OF, Lab
from tallyloom.sources.shared import shared_path
from tallyloom.streaming.feeds import consume, dimension_batch, dimension_table, read_usage, start_dimension, usage_batch


def usage_stream(lab: Lab) -> DataFrame:
    """The whole event table consumed as an append-only feed into the monthly fact."""
    spark, target, checkpoint = lab.spark, shared_path(lab.spark, "usage-fact"), shared_path(lab.spark, "usage-position")
    events = f"{lab.folder}/{{events}}.parquet"  # a glob, as the source takes a single file only by pattern
    for _ in range(2):  # the second run finds nothing new
        consume(spark, events, lab.raw("events").schema, checkpoint, usage_batch(target))
    return read_usage(spark, target).withColumn("total_session_minutes", dbl("total_session_minutes"))


def dimension_stream(lab: Lab) -> DataFrame:
    """The customer change feed consumed into the slowly changing dimension."""
    spark, feed, target, checkpoint = lab.spark, *(shared_path(lab.spark, n) for n in ("customer-feed", "customer-dim", "customer-position"))
    customer_feed(lab).withColumn("tenure_months", month_diff(F.col("created_date"), day(ORDERS_AS_OF))).write.parquet(feed)
    table = dimension_table(spark, target, _dimension(lab).schema, "customer_id", "customer_sk")
    start_dimension(table, _dimension(lab))
    apply = dimension_batch(table, ["company_name", "segment", "account_status"], F.lit(MERGED_AT).cast("timestamp_ntz"))
    consume(spark, feed, spark.read.parquet(feed).schema, checkpoint, apply)
    return table.read()


QUERIES = {"usage_stream": usage_stream, "dimension_stream": dimension_stream}
