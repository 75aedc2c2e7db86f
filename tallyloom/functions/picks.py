"""Repeatable pseudo-random picks from a key.

A draw is the first 48 bits of the MD5 digest of key and salt together, so that
the draws of one key are independent of each other and any filter on one leaves
the others even. The same key and salt give the same number on every run,
executor and engine, which ``rand()`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mixed(key: Column, salt: int) -> Column:
    """A number in [0, 2**48) from a key of any type and a salt."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def below(key: Column, salt: int, n: int) -> Column:
    """An integer in [0, n)."""
    return F.pmod(mixed(key, salt), F.lit(n).cast("bigint")).cast("int")


def between(key: Column, salt: int, low: int, high: int) -> Column:
    return F.lit(low) + below(key, salt, high - low + 1)


def pick(key: Column, salt: int, values: list) -> Column:
    """One entry of a list; repeat an entry to weight it."""
    return F.get(F.array(*[F.lit(v) for v in values]), below(key, salt, len(values)))
