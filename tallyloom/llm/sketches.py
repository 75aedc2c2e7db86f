"""Document fingerprints: threshold-scaled sketches, with DataFrame functions alone.

A sketch holds every hash of a document's word shingles below a fixed fraction
of the hash range, one in ``ONE_IN``, and the least hash whatever it is, so that no text with a
word has an empty sketch. Shingles of several widths are hashed, so that a short text
too keeps enough of them. Sketches of parts merge to that of the whole by union
(``merged``). The share of one sketch found in another estimates containment, also between
documents of very different lengths, with a standard error of about
sqrt(c * (1 - c) / kept hashes) at containment c; ``likeness`` is that of the smaller in the larger.

Each document is also compared with an edited text, whose last third is
replaced by the beginning of the next document in descending doc_id order. For
that, documents are dealt into ranges of (doc_id, hash) at quantiles, so that rows
that share an id or have none are split too; within a range the next row is a
window function over a bounded partition, and the first document of the
following range, found by aggregation, visits as a guest row. Texts are shuffled
once. Rows equal in both are never split.

Null text counts as empty: its sketch is empty, like 1 to another empty one and
0 to any other. Fewer words than a shingle make one shingle. Rows that share a
doc_id follow each other by their hashes; null doc_ids come after all others.
The next of the last document is the first. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keyed_texts

WIDTHS, ONE_IN = (2, 5), 2
LEAST_HASH = -(1 << 63)


def _limit(one_in: int) -> Column:
    """The bound below which hashes are kept."""
    if one_in < 1:
        raise ValueError("one_in is 1 or more")
    return F.lit(-(1 << 63) + (1 << 64) // one_in if one_in > 1 else (1 << 63) - 1)


def with_sketch(df: DataFrame, text: str, name: str, widths: tuple[int, ...] = WIDTHS, one_in: int = ONE_IN) -> DataFrame:
    """Add the sorted sketch of a text column; a text of fewer words than a width has its whole sequence as that width's shingle."""
    limit, none = _limit(one_in), F.array().cast("array<bigint>")
    df = df.withColumn("_words", F.transform(F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), ""), lambda w: F.xxhash64(w)))
    at = lambda i, k: F.element_at(F.col("_words"), i + 1 + k)
    shingle = lambda n: lambda w, i: F.xxhash64(w, *[at(i, k) for k in range(1, n)])
    parts = []
    for n in widths:
        long = F.transform(F.slice("_words", 1, F.greatest(F.size("_words") - (n - 1), F.lit(0))), shingle(n))
        short = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(none)
        parts.append(F.when(F.size("_words") >= n, long).otherwise(short))
    df = df.withColumn("_all", F.concat(*parts))
    least = F.when(F.size("_all") > 0, F.array(F.array_min("_all"))).otherwise(none)
    return df.withColumn(name, F.array_sort(F.array_distinct(F.concat(least, F.filter("_all", lambda h: (h < limit) | F.lit(one_in == 1)))))).drop("_words", "_all")


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Sketch of two parts together."""
    limit = _limit(one_in)
    both = F.array_sort(F.array_union(a, b))
    return F.filter(both, lambda h, i: (i == 0) | (h < limit) | F.lit(one_in == 1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds."""
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    return F.when(F.size(a) <= F.size(b), containment(a, b)).otherwise(containment(b, a))


def printed(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def _edges(texts: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Borders of ranges: th of those among rows without an id; doc_id and th of those among the others, ascending.

    There are four ranges for every shuffle partition. An id (or none) that many rows share is
    cut at quantiles of th. Borders need not be values of rows.
    """
    ranges = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    accuracy = max(10_000, 10 * ranges)
    quantiles = lambda k: [i / k for i in range(1, k)]
    cuts, n = texts.agg(F.percentile_approx("doc_id", quantiles(ranges), accuracy), F.count("*")).first()
    many = max(1, n // ranges)
    frequent = texts.groupBy("doc_id").count().where(F.col("count") > 2 * many).collect()  # fewer than ranges / 2
    ids, none = {(d, LEAST_HASH) for d in cuts or []}, set()
    if frequent:
        numbers = [r.doc_id for r in frequent if r.doc_id is not None]
        among = F.col("doc_id").isin(numbers) if numbers else F.lit(False)
        if len(numbers) < len(frequent):
            among = among | F.col("doc_id").isNull()
        ths = texts.where(F.coalesce(among, F.col("doc_id").isNull())).groupBy("doc_id").agg(F.percentile_approx("th", quantiles(ranges), accuracy).alias("ths"), F.count("*").alias("n"))
        for d, found, count in ths.collect():
            some = found[:: max(1, ranges // max(1, count // many))]
            if d is None:
                none |= set(some)
            else:
                ids |= {(d, t) for t in [LEAST_HASH, *some]}
    ids = sorted(ids)
    return sorted(none), [d for d, _ in ids], [t for _, t in ids]


def _constant(values: list[int]) -> Column:
    """A list as one constant, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _count_below(edges: list[list[int]], holds: Callable[[Column], Column]) -> Column:
    """How many of the ascending edges hold, found among every n-th of them and then between two of those.

    ``edges`` are columns of equal length; ``holds`` takes a struct of their values c0, c1.
    """
    step = isqrt(len(edges[0])) + 1
    zipped = lambda some: F.arrays_zip(*[_constant(e).alias(f"c{i}") for i, e in enumerate(some)])
    passed = F.size(F.filter(zipped([e[step - 1 :: step] for e in edges]), holds)) * step
    return passed + F.size(F.filter(F.slice(zipped(edges), passed + 1, step), holds))


def _in_ranges(docs: DataFrame) -> DataFrame:
    """Documents and guests with ``range`` and ``guest``, partitioned by range; ranges rise with (doc_id, th), null ids first."""
    texts = keyed_texts(docs)
    none, ids, ths = _edges(texts)
    doc_id, th = F.col("doc_id"), F.col("th")
    of_none = _count_below([none], lambda e: e["c0"] <= th)
    of_ids = _count_below([ids, ths], lambda e: (e["c0"] < doc_id) | ((e["c0"] == doc_id) & (e["c1"] <= th))) + len(none) + 1
    own = texts.withColumns({"range": F.when(doc_id.isNull(), of_none).otherwise(of_ids), "guest": F.lit(0)})
    # the first row of a range follows the last row of the range above it; that of the highest follows the lowest
    firsts = own.groupBy("range").agg(F.max(F.struct("doc_id", "th")).alias("row")).collect()  # at most a row for each range
    if firsts:
        firsts = sorted(((r["range"], *r["row"]) for r in firsts), key=lambda r: r[0])
        visits = list(zip([r[0] for r in firsts[1:] + firsts[:1]], firsts))
        columns = {"to": [to for to, _ in visits], "blank": [int(d is None) for _, (_, d, _) in visits], "id": [d or 0 for _, (_, d, _) in visits], "hash": [t for _, (_, _, t) in visits]}
        visit = texts.sparkSession.range(1).select(F.inline(F.arrays_zip(*[_constant(v).alias(k) for k, v in columns.items()])))
        same = (th == F.col("hash")) & (doc_id.isNull() == (F.col("blank") == 1)) & (F.coalesce(doc_id, F.lit(0)) == F.col("id"))
        guests = texts.join(F.broadcast(visit), same).groupBy("to").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("th").alias("th"))
        own = own.unionByName(guests.select("doc_id", "text", "th", F.col("to").cast("int").alias("range"), F.lit(1).alias("guest")))
    return own.repartition("range")


def fingerprints(docs: DataFrame, widths: tuple[int, ...] = WIDTHS, one_in: int = ONE_IN) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, sketch, edited_sketch, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_sketch(_in_ranges(docs), "text", "sketch", widths, one_in)
    following = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("th").desc())
    rows = rows.withColumn("following", F.lead(F.struct("text", "sketch")).over(following)).where("guest = 0")
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - k), F.substring("following.text", F.lit(1), k)))
    rows = with_sketch(rows, "edited", "edited_sketch", widths, one_in)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "sketch",
        "edited_sketch",
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("following.sketch")).alias("near_next"),
    )
