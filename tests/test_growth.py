"""Steps whose work must not grow faster than their input."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import with_summary
from tallyloom.operators.digest import digest
from tallyloom.sources.keyed import KeyedTable
from tallyloom.sources.shared import shared_path


def test_a_table_without_batches_asks_nothing_of_its_reader(spark):
    table = KeyedTable(spark, shared_path(spark, "unwritten"), spark.createDataFrame([], "k bigint, v string").schema, ["k"])
    asked = spark.range(3).select(F.raise_error(F.lit("evaluated")).cast("bigint").alias("k"))
    assert table.read(of=asked).collect() == [] and table.empty(before=0)


def test_a_batch_is_read_back_as_written(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k bigint, v string")
    table = KeyedTable(spark, shared_path(spark, "written"), rows.schema, ["k"])
    table.append(rows, 0)
    table.append(spark.createDataFrame([(2, "b")], rows.schema), 1)
    table.append(rows, 1)  # it is there already
    assert sorted(map(tuple, table.of_batch(0).collect()), key=str) == [(1, "a"), (2, None), (None, "c")]
    assert [tuple(r) for r in table.of_batch(1).collect()] == [(2, "b")]
    assert not table.empty(before=1) and table.empty(before=0)


def test_a_summary_sorts_without_a_comparing_function(spark):
    rows = spark.createDataFrame([(1, "b a. a c! c c? d"), (2, "one. two. three"), (3, "..."), (4, None)], "k int, t string")
    told = with_summary(rows, "t", "s")
    assert [r.s for r in told.orderBy("k").collect()] == ["a c. c c", "one. two", "", None]
    assert "array_sort(" not in told._jdf.queryExecution().analyzed().toString()


def _texts(spark):
    said = [(1, "g", "red red fox. blue fox! green hen"), (2, "g", "red hen. blue cow"), (3, "h", "fox. fox fox cow"), (3, "h", "fox. fox fox cow"), (4, None, "red cow. lone"), (5, "h", None)]
    return spark.createDataFrame(said, "k int, g string, t string")


@pytest.mark.parametrize("groups", [["g"], []])
def test_a_digest_is_the_same_however_many_terms_are_frequent(spark, groups):
    told = [sorted(map(tuple, digest(_texts(spark), groups, "k", "t", min_chars=1, frequent=n).collect()), key=str) for n in (0, 2, 1000)]
    assert told[0] == told[1] == told[2] and len(told[0]) == (2 if groups else 1)


def test_words_with_frequent_terms_are_not_shuffled(spark):
    """Where all terms are frequent, only sentences leave the tasks that read them."""
    plan = digest(_texts(spark), ["g"], "k", "t", min_chars=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "strategy=broadcast" in plan
