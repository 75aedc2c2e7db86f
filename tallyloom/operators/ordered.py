"""Ordered scans (row number, running sum, lag, lead) that no hot group can stall.

A window partitioned by a column of few values, or by nothing, sorts each group
in one task. Here the rows are range-partitioned on (group, order), so a large
group is spread over many tasks; each task numbers its own stretch, and one
small row per (group, stretch) carries totals and edge values across stretches.

The range-partitioned rows are checkpointed: the sampled range bounds and the
position inside a partition are then fixed for every reader of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.shared import cut_lineage

_INDEX_BITS = 33  # monotonically_increasing_id: partition in the high bits, row index in the low 33


def ranged_rows(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows range-partitioned and sorted on (group, order), with partition ``_part`` and position ``_at`` fixed."""
    by = [*[F.col(g) for g in groups], *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    return cut_lineage(ranged).withColumn("_part", F.shiftright("_at", _INDEX_BITS))


def ordered_scan(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    row_number: str | None = None,
    group_rows: str | None = None,
    running: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
) -> DataFrame:
    """Add order-dependent columns per group; ``order`` must end with a unique column.

    ``running`` maps a new column to the column it sums up to and including the
    row; ``lag`` and ``lead`` map a new column to the neighbour's column.
    """
    running, lag, lead = running or {}, lag or {}, lead or {}
    groups = list(groups)
    ranged = ranged_rows(df, groups, order)

    stretch_keys = [*groups, "_part"]
    stretches = ranged.groupBy(*stretch_keys).agg(
        F.count("*").alias("_n"),
        F.min("_at").alias("_first"),
        *[F.sum(c).alias(f"_sum_{n}") for n, c in running.items()],
        *[F.max_by(F.struct(F.col(c)), "_at").alias(f"_last_{n}") for n, c in lag.items()],
        *[F.min_by(F.struct(F.col(c)), "_at").alias(f"_next_{n}") for n, c in lead.items()],
    )
    across = Window.partitionBy(*groups).orderBy("_part")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        *stretch_keys,
        F.col("_first"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*groups)).alias("_group_n"),
        *[F.sum(f"_sum_{n}").over(before).alias(f"_sum_{n}") for n in running],
        *[F.lag(f"_last_{n}").over(across).alias(f"_last_{n}") for n in lag],
        *[F.lead(f"_next_{n}").over(across).alias(f"_next_{n}") for n in lead],
    )
    # Joined on (group, stretch): one small row per stretch; Spark broadcasts it only if its size allows.
    left, right = ranged.alias("l"), stretches.alias("r")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in stretch_keys]
    joined = left.join(right, on).select("l.*", *[f"r.{c}" for c in stretches.columns if c not in stretch_keys])

    inside = Window.partitionBy(*stretch_keys).orderBy("_at")
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_offset") + F.col("_at") - F.col("_first") + 1).alias(row_number))
    if group_rows:
        out.append(F.col("_group_n").alias(group_rows))
    for n, c in running.items():
        local = F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        earlier = F.col(f"_sum_{n}")  # null while every value so far is null, as a window's sum is
        out.append(F.when(earlier.isNull(), local).otherwise(earlier + F.coalesce(local, F.lit(0))).alias(n))
    for n, c in lag.items():
        local = F.lag(F.struct(F.col(c))).over(inside)
        out.append(F.coalesce(local, F.col(f"_last_{n}"))[c].alias(n))
    for n, c in lead.items():
        local = F.lead(F.struct(F.col(c))).over(inside)
        out.append(F.coalesce(local, F.col(f"_next_{n}"))[c].alias(n))
    return joined.select(*out)


def dense_ids(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Surrogate keys 1..n in a global order, numbered in parallel."""
    return ordered_scan(df, [], order, row_number=name)


def group_median(df: DataFrame, groups: Sequence[str], value: str, unique: str, name: str) -> DataFrame:
    """Exact PERCENTILE_CONT(0.5) of a money column per group.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer; this picks the middle one or two rows of the distributed order.
    """
    ranked = ordered_scan(
        df.filter(F.col(value).isNotNull()).select(*groups, value, unique),
        groups, [F.col(value), F.col(unique)], row_number="_rn", group_rows="_n",
    )
    low, high = F.floor((F.col("_n") + 1) / 2), F.ceil((F.col("_n") + 1) / 2)
    middle = ranked.filter((F.col("_rn") == low) | (F.col("_rn") == high))
    return middle.groupBy(*groups).agg((F.sum(F.col(value).cast("double")) / F.count("*")).alias(name))
