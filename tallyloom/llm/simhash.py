"""SimHash near-duplicates by multi-index hashing.

The 64-bit fingerprint of a text has a bit set if more than half of its
shingles' XXH64 values have it set. Fingerprints link at ``most`` or fewer
differing bits; the links' connected components are the groups.

Fingerprints are cut into ``segments`` parts. Two that link differ by at most
``most // segments`` bits in some part, so for each part the small Hamming ball
around its value is enumerated, the fingerprints that have one of these values
there are fetched by an equi-join, and the complete distance is verified. Of
two parts only the smaller enumerates. A value that more than ``HOT``
fingerprints share is never compared in pairs: its fingerprints are looked up by
this part and another one together, and so on until every part is in the key.

Only distinct fingerprints are indexed, with the counts of their copies, so a
group of copies is one row; a fingerprint has few neighbours within ``most``
bits, so links do not grow with the square of a group.

Null or empty text has fingerprint zero, linked like any other; a text of fewer
words than a shingle is one shingle. component_id is the least doc_id that is
not null. Rows that repeat a doc_id are documents of their own. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keyed_texts, modest_batches, one_of_repeats, packed_rows, stored, utf8
from tallyloom.llm.components import components

HOT = 4096
BITS = 64


def fingerprint(text: bytes, words: int) -> int:
    """Fingerprint of UTF-8 text, as an unsigned number; shingles are hashed in bounded pieces."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, n, 1 << 15):
        some = w[lo : min(n, lo + (1 << 15)) + words - 1]
        shingles = map(b" ".join, zip(*[some[i:] for i in range(words)])) if len(w) >= words else [b" ".join(w)]
        h = np.array([xxh64_intdigest(s, 42) for s in shingles], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in range(BITS) if 2 * ones[i] > n)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, th and fp (the fingerprint's 64 bits as a long) of every document."""

    def each(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            prints = np.array([fingerprint(data[offsets[i] : offsets[i + 1]].tobytes(), words) for i in range(len(offsets) - 1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "th", "fp"])

    return modest_batches(keyed_texts(docs).select("doc_id", "th", "text")).mapInArrow(each, "doc_id long, th long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(segments: int) -> list[int]:
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]


def _ball(mask: int, radius: int) -> Column:
    """All flips of at most ``radius`` bits of a part."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    flips = [_signed(sum(c)) for r in range(radius + 1) for c in combinations(bits, r)]
    return F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>")  # one constant, however large


def _extended(rows: DataFrame, masks: list[int], most: int, probe: bool, level: int) -> DataFrame:
    """Rows (parts, key, fp, spent) with one more part in the key; of a probe, with every value in the ball around it."""
    out = None
    for i, mask in enumerate(masks):
        part = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        some = rows.where(F.col("parts").bitwiseAND(F.lit(1 << i)) == 0)
        if not probe:
            one = some.withColumn("key", F.col("key").bitwiseOR(part))
        else:
            # ``spent`` bits differ so far; the parts still out of the key share the rest
            flips = F.filter(_ball(mask, most // (len(masks) - level)), lambda f: F.bit_count(f) <= F.floor((F.lit(most) - F.col("spent")) / (len(masks) - level)))
            values = F.transform(flips, lambda f: part.bitwiseXOR(f))
            if level == 0:
                values = F.filter(values, lambda v: v >= part)
            one = some.withColumn("value", F.explode(values)).withColumns({"key": F.col("key").bitwiseOR(F.col("value")), "spent": F.col("spent") + F.bit_count(F.col("value").bitwiseXOR(part))}).drop("value")
        one = one.withColumn("parts", F.col("parts").bitwiseOR(F.lit(1 << i)))
        out = one if out is None else out.unionByName(one)
    return out


def links(prints: DataFrame, most: int = 2, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` at most ``most`` bits apart."""
    masks, found = _masks(segments), None
    blank = prints.select(F.lit(0).alias("parts"), F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("spent"))
    table, probes = blank, blank
    for level in range(segments):
        table = _extended(table, masks, most, False, level)
        if level:
            table = table.distinct()
        table = stored(table, "table")
        sizes = stored(table.groupBy("parts", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT), "hot")
        probes = _extended(probes, masks, most, True, level)
        hot = not sizes.isEmpty()
        if hot:
            probes = stored(probes, "probes")
        keys = ["parts", "key"]
        rare, asked = (table.join(sizes, keys, "left_anti"), probes.join(sizes, keys, "left_anti")) if hot else (table, probes)
        # Spark sizes the exploded balls by the fingerprints they come from, so it would broadcast them: both sides are sorted
        met = asked.withColumnRenamed("fp", "a").join(rare.drop("spent").withColumnRenamed("fp", "b").hint("merge"), keys)
        apart = F.col("a").bitwiseXOR(F.col("b"))
        met = met.where((F.col("a") != F.col("b")) & (F.bit_count(apart) <= most))
        if level == 0:  # a pair that agrees in several parts is taken at the first, and once
            met = met.where((F.col("spent") > 0) | (F.col("a") < F.col("b")))
            for i in range(1, segments):
                sooner = [F.bit_count(apart.bitwiseAND(F.lit(_signed(m)))) > most // segments for m in masks[:i]]
                met = met.where(reduce(and_, sooner, F.lit(True)) | (F.col("parts") != 1 << i))
        met = stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "met")
        found = met if found is None else found.unionByName(met)
        if not hot:
            break
        table = table.join(sizes.select(*keys), keys, "left_semi")
        probes = probes.join(sizes.select(*keys), keys, "left_semi")
    return found.distinct()


def grouped(docs: DataFrame, words: int = 3, most: int = 2, segments: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, fp) and, per fingerprint, (fp, root, component_id); both stored."""
    rows = stored(fingerprints(docs, words), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_prints")
    roots = components(links(prints, most, segments))
    told = stored(prints.join(roots, prints.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"), "rooted")
    lows = stored(told.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    return rows, stored(told.join(lows, "root").select("fp", "root", "component_id"), "groups")


def near_groups(docs: DataFrame, words: int = 3, most: int = 2, segments: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows, groups = grouped(docs, words, most, segments)
    return rows.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, most: int = 2, segments: int = 2) -> DataFrame:
    """Of each group the document with the least doc_id (null last), all its columns unchanged; others go."""
    return keep_of_groups(docs, *grouped(docs, words, most, segments))


def keep_of_groups(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents with the least doc_id of each root, given rows (doc_id, th, fp) and groups (fp, root)."""
    told = rows.join(groups, "fp")
    chosen = told.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("win")).select("win.doc_id", "win.th")
    chosen = stored(chosen, "chosen")
    same = rows.doc_id.eqNullSafe(chosen.doc_id) & (rows.th == chosen.th)
    wins = stored(rows.join(chosen, same, "left_semi").groupBy(F.col("doc_id").alias("id"), F.col("th").alias("hash")).agg(F.count("*").alias("copies")), "wins")
    full = docs.select(packed_rows(docs).alias("row"), F.col("doc_id").cast("long").alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"))
    found = full.join(wins, (F.col("own") == F.col("hash")) & F.col("doc").eqNullSafe(F.col("id")))
    if wins.where("copies > 1").isEmpty():
        return found.select("row.*")
    return one_of_repeats(found, ["hash", "id"]).select("row.*")
