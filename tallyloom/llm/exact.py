"""Exact deduplication against a minimal perfect hash of historical digests.

Texts are equal when their SHA-256 after lower-casing A-Z is. The history's
distinct digests are dealt into shards of about ``SHARD_KEYS`` by digest bits;
each shard gets a minimal perfect hash by displacement: keys fall into small
groups, and a pilot number per group sends every key of the shard to a slot of
its own, 0 to n-1 without gaps. Pilots are tried in a pseudo-random order, as
consecutive ones reach only some of the slots where a key's step is small and
shares a factor with n. A slot holds the full digest, the locator of
the row that stays and the group's size. An incoming digest finds its group's
pilot, computes its slot and is a member only if the digest in the slot is the
same, byte for byte; nonmembers are grouped among themselves.

Only digests and ids move. Copies are counted before the shuffle, so a group
of a third of all rows is a few rows; the join that hands decisions back to
rows is a plain equi-join whose hot partitions adaptive execution splits.

Null text counts as empty. Of equal texts the row with the largest doc_id
stays, null below all; of rows that also share the doc_id, exactly one.
An empty history or table is a table without members. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ascii_lower, one_of_repeats, packed_rows, stored, texts_of

SHARD_KEYS, GROUP_KEYS = 2048, 4
PRIME = (1 << 31) - 1  # slots are ((a + pilot * b) mod PRIME) mod n
_MOST_PILOTS = 1 << 22


def digest_of(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def _bits(at: int, n: int) -> Column:
    return F.conv(F.substring("digest", at, n), 16, 10).cast("long")


def placed(df: DataFrame, shards: int) -> DataFrame:
    """Add the shard and the numbers a, b and g of each digest (disjoint bits of it)."""
    return df.withColumns({"shard": F.pmod(_bits(1, 14), F.lit(shards)), "a": _bits(15, 7), "b": _bits(22, 7) + 1, "g": _bits(29, 7)})


def _tries(first: int, n: int) -> np.ndarray:
    """The pilots first to first + n - 1 of a fixed pseudo-random sequence below PRIME (SplitMix64)."""
    x = np.arange(first + 1, first + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(PRIME)).astype(np.int64)


def find_pilots(a: np.ndarray, b: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilot and slot of every key of a shard; slots are 0..n-1, each used once."""
    n = len(a)
    pilots, slots, taken = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    order = np.argsort(group, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if n else []
    for keys in sorted(members, key=len, reverse=True):
        first, step = 0, 64
        while True:
            tries = _tries(first, step)
            at = (a[keys][None, :] + tries[:, None] * b[keys][None, :]) % PRIME % n
            ok = ~taken[at].any(axis=1)
            if len(keys) > 1:
                ranked = np.sort(at, axis=1)
                ok &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if ok.any():
                k = int(np.argmax(ok))
                pilots[keys], slots[keys] = tries[k], at[k]
                taken[at[k]] = True
                break
            first, step = first + step, min(step * 2, 1 << 14)
            if first > _MOST_PILOTS:
                raise RuntimeError("two digests of a group agree in 56 bits: rebuild with another shard count")
    return pilots, slots


def build_index(groups: DataFrame) -> tuple[DataFrame, int]:
    """Slots of the history's (digest, win, n) rows, stored, and the number of shards."""
    groups = stored(groups, "history")
    shards = max(1, math.ceil(groups.count() / SHARD_KEYS))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        size = len(pdf)
        group = (pdf["g"] % max(1, -(-size // GROUP_KEYS))).to_numpy()
        pilot, slot = find_pilots(pdf["a"].to_numpy(), pdf["b"].to_numpy(), group)
        return pd.DataFrame({"shard": pdf["shard"], "grp": group, "pilot": pilot, "size": size, "slot": slot, "digest": pdf["digest"], "doc_id": pdf["doc_id"], "row": pdf["row"], "n": pdf["n"]})

    flat = placed(groups.select("digest", F.col("win.doc_id").alias("doc_id"), F.col("win.row").alias("row"), "n"), shards)
    slots = flat.groupBy("shard").applyInPandas(shard, "shard long, grp long, pilot long, size long, slot long, digest string, doc_id long, row long, n long")
    return stored(slots, "slots"), shards


def look_up(slots: DataFrame, shards: int, groups: DataFrame) -> DataFrame:
    """``groups`` (digest, win, n) with ``member``: its digest is in the slot that the hash gives."""
    pilots = slots.groupBy("shard", "grp").agg(F.first("pilot").alias("pilot"), F.first("size").alias("size"))
    sizes = slots.groupBy("shard").agg(F.first("size").alias("keys"))
    keyed = placed(groups, shards).join(sizes, "shard", "left")
    keyed = keyed.withColumn("grp", F.pmod("g", F.greatest(F.lit(1), F.ceil(F.col("keys") / GROUP_KEYS))))
    keyed = keyed.join(pilots, ["shard", "grp"], "left").withColumn("slot", F.pmod(F.pmod(F.col("a") + F.col("pilot") * F.col("b"), F.lit(PRIME)), F.col("size")))
    held = slots.select("shard", "slot", F.col("digest").alias("held"))
    return keyed.join(held, ["shard", "slot"], "left").select("digest", "win", "n", F.coalesce(F.col("digest") == F.col("held"), F.lit(False)).alias("member"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("win"), F.count("*").alias("n"))


def decide(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Of each distinct digest of two batches of (doc_id, row, digest): the row that stays and the number of rows."""
    slots, shards = build_index(_groups(history))
    met = stored(look_up(slots, shards, _groups(incoming)), "met")
    held = slots.select("digest", F.struct("doc_id", "row").alias("win"), "n")
    members = held.unionByName(met.where("member").drop("member")).groupBy("digest").agg(F.max("win").alias("win"), F.sum("n").alias("n"))
    return members.unionByName(met.where("NOT member").drop("member"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The rows in the upper half of the id range serve as the history, the others
    as the incoming batch; the result is that of the whole table.
    """
    rows = stored(texts_of(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), digest_of(F.col("text")).alias("digest")), "digests")
    edge = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    old = F.coalesce(F.col("doc_id") > F.lit((edge[0] or 0) // 2 + (edge[1] or 0) // 2), F.lit(False))
    final = stored(decide(rows.where(old), rows.where(~old)), "decisions")
    return rows.join(final, "digest").select(
        "doc_id",
        F.col("win.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("win.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, all their columns unchanged."""
    staying = dedup(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    wins = stored(staying.groupBy(F.col("text_sha256").alias("digest"), F.col("doc_id").alias("id")).agg(F.count("*").alias("copies")), "wins")
    rows = docs.select(packed_rows(docs).alias("row"), F.col("doc_id").cast("long").alias("doc"), digest_of(F.col("text")).alias("own"))
    found = rows.join(wins, (F.col("own") == F.col("digest")) & F.col("doc").eqNullSafe(F.col("id")))
    if wins.where("copies > 1").isEmpty():
        return found.select("row.*")
    return one_of_repeats(found, ["digest", "id"]).select("row.*")
