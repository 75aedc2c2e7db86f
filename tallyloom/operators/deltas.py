"""Signed changes: what a batch takes away and what it adds, carried through joins and sums.

A changed key gives its old image with sign -1 and its new one with sign +1. Sums
and counts of a group move by the signed sums of its rows; sets, distinct counts,
least and greatest values are kept as counted values, which leave when their count
falls to zero. States are keyed tables: a batch reads the groups it touches and
writes those alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.keyed import KeyedTable


def signed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The images of the keys that differ, with ``sign``; both sides hold a key once."""
    columns = new.columns
    sides = old.select(*columns, F.lit(-1).alias("sign")).unionByName(new.select(*columns, F.lit(1).alias("sign")))
    image = F.struct(*columns)
    both = sides.groupBy(*keys).agg(F.max(F.when(F.col("sign") < 0, image)).alias("_old"), F.max(F.when(F.col("sign") > 0, image)).alias("_new"))
    moved = both.where(~F.col("_old").eqNullSafe(F.col("_new")))
    steps = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("row"), F.lit(s).alias("sign"))) for c, s in (("_old", -1), ("_new", 1))]))
    return moved.select(F.explode(steps).alias("c")).select("c.row.*", "c.sign")


def signed_sum(value: Column | int = 1) -> Column:
    """The change of a sum, or of a count, that signed rows make."""
    return F.sum(F.col("sign") * (F.lit(value) if isinstance(value, int) else value))


def moved_state(table: KeyedTable, changes: DataFrame, batch: int) -> DataFrame:
    """New rows of the groups of an additive state that ``changes`` (keys, sums) of a batch touches."""
    sums = [c for c in changes.columns if c not in table.keys]
    held = table.read(of=changes, before=batch)
    same = reduce(lambda a, b: a & b, [held[k].eqNullSafe(F.col(f"_{k}")) for k in table.keys])
    touched = changes.select(*[F.col(k).alias(f"_{k}") for k in table.keys]).distinct()
    both = held.join(touched, same, "left_semi").select(*table.keys, *sums).unionByName(changes.select(*table.keys, *sums))
    return both.groupBy(*table.keys).agg(*[F.sum(c).cast(table.schema[c].dataType).alias(c) for c in sums])


def entered(table: KeyedTable, changes: DataFrame, count: str, batch: int) -> DataFrame:
    """``changes`` (keys, count) of counted values as (keys, step): +1 for a value that now occurs, -1 for one that no longer does."""
    held = table.read(of=changes, before=batch).select(*[F.col(k).alias(f"_{k}") for k in table.keys], F.col(count).alias("_was"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in table.keys])
    joined = changes.join(held, same, "left").withColumn("_before", F.coalesce("_was", F.lit(0)))
    step = (F.col("_before") + F.col(count) > 0).cast("int") - (F.col("_before") > 0).cast("int")
    return joined.select(*table.keys, step.alias("step")).where("step <> 0")
