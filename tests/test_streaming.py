"""Streaming consumers: once per row, several batches, repeatable batches."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.changes import change_feed, merge_dimension
from tallyloom.plans.incremental import USAGE_SUMS, monthly_usage
from tallyloom.sources.commits import Conflict, commit, entries
from tallyloom.sources.lab import Lab, daily_usage_of
from tallyloom.sources.shared import shared_path
from tallyloom.streaming.feeds import consume, dimension_batch, dimension_table, read_usage, start_dimension, usage_batch

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def test_usage_in_batches(spark):
    events = Lab(spark, FOLDER).raw("events")
    feed, target, position = (shared_path(spark, n) for n in ("feed", "fact", "position"))
    early, late = events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-16'")
    early.repartition(3).write.parquet(feed)
    run = lambda: consume(spark, feed, events.schema, position, usage_batch(target), files_per_batch=2)
    run()
    run()  # nothing new
    late.coalesce(1).write.mode("append").parquet(feed)
    run()
    got, want = read_usage(spark, target), monthly_usage(daily_usage_of(events))
    assert rows(got.select("customer_id", "usage_month", *USAGE_SUMS)) == rows(want.select("customer_id", "usage_month", *USAGE_SUMS))
    usage_batch(target)(late, 2)  # a repeated batch replaces its own output
    assert rows(read_usage(spark, target).select(*USAGE_SUMS)) == rows(want.select(*USAGE_SUMS))


def test_dimension_batch_is_repeatable(spark):
    target = shared_path(spark, "dim")
    dim = spark.sql("SELECT 1 sk, 1 k, 'A' s, true is_current, DATE'2024-01-01' effective_from, CAST(NULL AS DATE) effective_to")
    table = dimension_table(spark, target, dim.schema, "k", "sk", buckets=4)
    start_dimension(table, dim)
    feed = change_feed(spark.createDataFrame([(1, "A")], "k int, s string"), spark.createDataFrame([(1, "B"), (2, "N")], "k int, s string"), ["k"])
    step = dimension_batch(table, ["s"], F.lit("2024-02-01").cast("date"))
    step(feed, 0)
    once = rows(table.read())
    step(feed, 0)
    assert rows(table.read()) == once and len(once) == 3


def test_dimension_batches_write_their_changes_alone(spark):
    many = spark.range(2000).selectExpr("int(id + 1) sk", "int(id) k", "'A' s", "true is_current", "DATE'2024-01-01' effective_from", "CAST(NULL AS DATE) effective_to")
    table = dimension_table(spark, shared_path(spark, "dim"), many.schema, "k", "sk")
    start_dimension(table, many)
    want = many
    for day_, (ids, state) in enumerate([([3, 5, 9000], "B"), ([5, 9000, 9001], "C"), ([3], "C")]):
        old = want.filter("is_current").select("k", "s")
        new = old.filter(~F.col("k").isin(ids)).unionByName(spark.createDataFrame([(i, state) for i in ids], "k int, s string"))
        feed, at = change_feed(old, new, ["k"]), F.lit(f"2024-02-0{day_ + 1}").cast("date")
        want = merge_dimension(want, feed, "k", ["s"], at, "sk").checkpoint()
        dimension_batch(table, ["s"], at)(feed, day_)
        assert rows(table.read().select(want.columns)) == rows(want)
        if day_ == 1:
            table.compact([0, 1, 2, 3])
            table.compact()
    log = entries(spark, table.root)
    assert [e.rows for e in log if e.batch is not None] == [2000, 5, 5, 2]
    assert table.mark() == 2007


def test_one_version_has_one_writer(spark):
    root = shared_path(spark, "log")
    commit(spark, root, 0, "data/a", rows=1)
    with pytest.raises(Conflict):
        commit(spark, root, 0, "data/b", rows=1)
    commit(spark, root, 1, "data/b", rows=2)
    assert [(e.version, e.folder, e.rows) for e in entries(spark, root)] == [(0, "data/a", 1), (1, "data/b", 2)]
    assert entries(spark, shared_path(spark, "none")) == []
