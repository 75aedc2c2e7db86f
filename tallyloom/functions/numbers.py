"""Small numeric expressions shared by the products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rounded(c, scale: int) -> Column:
    """Half-up rounding in binary arithmetic: scale up, round to an integer, scale down."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * float(10**scale), 0) / float(10**scale)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0."""
    return dbl(a) / F.nullif(dbl(b), F.lit(0.0))


def safe_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    return rounded(dbl(part) * 100.0 / F.nullif(dbl(whole), F.lit(0.0)), scale)


def mean(c, scale: int = 4) -> Column:
    """Average as exact sum over count, rounded: the same on every partitioning."""
    c = F.col(c) if isinstance(c, str) else c
    return rounded(safe_div(F.sum(c), F.count(c)), scale)


def count_when(p: Column) -> Column:
    return F.count(F.when(p, 1))


def sum_when(p: Column, x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.sum(F.when(p, x).otherwise(F.lit(0).cast(MONEY)))


def bytes_as(c, power: int, scale: int | None = None) -> Column:
    """Bytes in units of 1024**power (3 = GB, 4 = TB)."""
    v = dbl(c) / float(1024**power)
    return v if scale is None else rounded(v, scale)
