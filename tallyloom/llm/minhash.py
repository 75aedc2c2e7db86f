"""Near copies by circulant MinHash: texts whose sets of word shingles have a Jaccard similarity of at least ``least`` hundredths.

Two permutations make a whole signature. The first, sigma, mixes the 64-bit hash
of a shingle; the second, pi, is applied to sigma's value circularly shifted by k,
that is to (sigma - k) modulo 2**64, and its least value over the set is
coordinate k. ``BANDS`` bands of ``DEEP`` coordinates are compared; a pair at 0.8
shares none with a probability of (1 - 0.8**DEEP)**BANDS, 0.00002; one at 0.4 shares
any with 0.14, so that unlike texts with a common passage seldom meet.

Candidates are confirmed by the exact similarity of the two full sets, and the
confirmed links' connected components are the groups. Texts of equal sets are
one node. Bands are taken in a few rounds, the first of two bands alone, and after
each comparison linked nodes are contracted: in the next a group of near copies is
one root that is not compared with itself. In a band value whose nodes have different
roots, one pivot and then about eight more are compared with every node of another
root and are done with, which joins most groups of near copies.

What is still mixed then are nodes with much in common that are not similar: to
compare all of them would cost the square of their number. They are split by prefixes
instead: with shingles in one order for all sets, those of fewest nodes first, two
similar sets share one among their first few, and these are mostly a node's own where
it departs from the others. Nodes are bucketed by these shingles and both size classes,
as sizes fix the length of the prefixes; no similar pair is lost. Where the classes
differ, only nodes of different classes are compared. Buckets whose nodes
have different roots are settled by pivots, eight times as many in each turn. Set sizes
alone rule out pairs that cannot reach the similarity.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text of fewer words than a
shingle has its whole sequence as its one shingle. Null, empty and blank texts have
no shingles and are linked with nothing. component_id is the least doc_id that is
not null; rows that repeat a doc_id are documents of their own; a document without
an id, in no group with one, has no component_id and is kept. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keyed_texts, modest_batches, slices, stored, utf8
from tallyloom.llm.components import components
from tallyloom.llm.runs import byte_units, mixed, prefix_hash, stretch_hash, words_of

WORDS, LEAST = 2, 80
BANDS, DEEP = 36, 6
ROUNDS = ((0, 2), (2, 8), (8, BANDS))  # bands that are compared together
TURNS = 2  # of pivots, before buckets are split
PIECE = 1 << 14  # shingles whose coordinates are taken at once
_TAG = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each of consecutive texts, which lie at ``offsets`` in ``data``."""
    at = offsets - offsets[0]
    ends = at[1:] + np.arange(len(at) - 1)  # a space after every text keeps their words apart
    joined = np.insert(_LOW[data[offsets[0] : offsets[-1]]], at[1:], 32)
    first, last = words_of(joined)
    units = stretch_hash(prefix_hash(byte_units(joined), 0), first, last, 0)
    edges = np.searchsorted(first, np.append(0, ends + 1))
    h = units.copy()
    for k in range(1, words):
        h[:-k] = mixed(h[:-k] * _TAG + units[k:]) if len(h) > k else h[:-k]
    for lo, hi in zip(edges, edges[1:]):
        if hi - lo >= words:
            yield np.unique(h[lo : hi - words + 1])
        elif hi > lo:
            whole = units[lo]
            for u in units[lo + 1 : hi]:
                whole = mixed(np.array([whole * _TAG + u]))[0]
            yield mixed(np.array([whole + np.uint64(hi - lo)]))
        else:
            yield units[:0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``BANDS * DEEP`` coordinates of every set, none of which is empty."""
    out = np.empty((len(sets), BANDS * DEEP), np.uint64)
    sizes = np.cumsum([0] + [len(s) for s in sets])
    for lo, hi in slices(sizes, PIECE):
        sigma = mixed(np.concatenate(sets[lo:hi]) + _TAG)
        begins = sizes[lo:hi] - sizes[lo]
        x, y = np.empty_like(sigma), np.empty_like(sigma)
        for k in range(BANDS * DEEP):
            np.subtract(sigma, np.uint64(k), out=x)
            for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                np.right_shift(x, np.uint64(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                np.multiply(x, np.uint64(times), out=x)
            out[lo:hi, k] = np.minimum.reduceat(x, begins)
    return out


def band_values(coordinates: np.ndarray) -> np.ndarray:
    """A hash of each band's coordinates and its number."""
    bands = coordinates.reshape(len(coordinates), BANDS, DEEP)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
    for k in range(DEEP):
        h = mixed(h * _TAG + bands[:, :, k])
    return h


def _nodes(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, th, fp (128 bits of the set, null if empty), n (its size) and bands of every document."""

    def each(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in slices(offsets, 1 << 20):
                sets = list(shingle_sets(data, offsets[lo : hi + 1], words))
                full = [s for s in sets if len(s)]
                bands = iter(band_values(signatures(full)).view(np.int64))
                columns = [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(1).slice(lo, hi - lo),
                    pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "fp", "n", "bands"])

    return modest_batches(keyed_texts(docs).select("doc_id", "th", "text")).mapInArrow(each, "doc_id long, th long, fp binary, n long, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(fp, shingles) of the wanted (fp, th, id), from one row of each."""

    def each(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets, 1 << 20):
                sets = [s.view(np.int64) for s in shingle_sets(data, offsets[lo : hi + 1], words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "shingles"])

    texts = keyed_texts(docs)
    texts = texts.join(wanted, (texts.th == wanted.hash) & texts.doc_id.eqNullSafe(wanted.id))
    return modest_batches(texts.select("fp", "text")).mapInArrow(each, "fp binary, shingles array<bigint>").dropDuplicates(["fp"])


def _linked(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links between roots (a, b) of the pairs (a, ra, b, rb) whose sets are that similar."""
    of = lambda name, as_: sets.select(F.col("fp").alias(name), F.col("shingles").alias(as_))
    both = pairs.join(of("b", "y"), "b").join(of("a", "x"), "a")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    return both.where(100 * shared >= least * (F.size("x") + F.size("y") - shared)).select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (fp, root) after links between roots."""
    new = components(links)
    if labels is None:
        return new.withColumnRenamed("node", "fp")
    higher = new.select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = labels.join(higher, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))
    return stored(old.unionByName(new.withColumnRenamed("node", "fp").join(labels.select("fp"), "fp", "left_anti")), "labels")


def _pivoted(active: DataFrame, labels: DataFrame | None, sets: DataFrame, least: int, turns: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Nodes (band, fp, n, side) of buckets that pivots have not settled after ``turns`` (None: all are settled), and labels. Nodes of one side, if it is not null, are not compared."""
    turn = 0
    while True:
        root = F.col("fp") if labels is None else F.coalesce("root", "fp")
        told = (active if labels is None else active.join(labels, "fp", "left")).select("band", "fp", "n", "side", root.alias("root"))
        opposed = F.min("side").isNull() | (F.min("side") < F.max("side"))
        mixed_ = told.groupBy("band").agg(((F.min("root") < F.max("root")) & opposed).alias("mixed")).where("mixed").select("band")
        active = stored(told.join(mixed_, "band"), "active")
        if turn == turns or active.isEmpty():
            return active.drop("root"), labels
        # the same pivots in every band
        slot = F.pmod(F.xxhash64("fp", F.lit(turn)), F.lit(1 << 3 * turn))
        first = F.min(F.struct(F.xxhash64("fp", F.lit(turn), F.lit(1)), "fp", "n", "root", "side")).alias("p")
        pivots = active.groupBy("band", slot.alias("slot")).agg(first)
        pivots = pivots.select("band", F.col("p.fp").alias("a"), F.col("p.n").alias("na"), F.col("p.root").alias("ra"), F.col("p.side").alias("sa"))
        pivots = stored(pivots, "pivots")
        near = 100 * F.least("n", "na") >= least * F.greatest("n", "na")
        apart = F.coalesce(F.col("side") != F.col("sa"), F.lit(True))
        met = active.join(pivots, "band").where((F.col("root") != F.col("ra")) & apart & near).select("a", "ra", F.col("fp").alias("b"), F.col("root").alias("rb"))
        links = stored(_linked(stored(met.distinct(), "met"), sets, least), "new_links")
        if not links.isEmpty():
            labels = _joined(labels, links)
        active = active.join(pivots.select("band", F.col("a").alias("fp")), ["band", "fp"], "left_anti").drop("root")
        turn += 1


def size_class(n: int) -> tuple[int, int]:
    """Least and greatest size of the class that a set of n shingles is in: n alone below 256, then a 128th of n at most."""
    shift = max(n.bit_length() - 8, 0)
    return n >> shift << shift, n | (1 << shift) - 1


@lru_cache(1 << 10)
def prefixes(n: int, least: int) -> np.ndarray:
    """Rows (low, high, length) for every size class that a set of n shingles can have similar sets in: any of them holds one of its first ``length`` shingles, in an order that all sets share."""
    out, size = [], -(-least * n // 100)
    while size <= 100 * n // least:
        low, high = size_class(size)
        out.append((low, high, n + 1 + -least * (n + low) // (100 + least)))
        size = high + 1
    return np.array(out, np.int64)


def prefix_values(n: int, alone: int, shared: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a set's first shingles with both size classes, and on which side of these the set is, -1 where they are one. ``alone`` shingles that no other set holds come before ``shared``, of which sets of ``low`` to ``high`` shingles hold each."""
    classes = prefixes(n, least)
    length = classes[:, 2:] - alone
    most = max(int(length.max()), 0)
    place, shared, low, high = np.arange(len(shared))[:most], shared[:most], low[:most], high[:most]
    c, k = np.nonzero((place < length) & (low <= classes[:, 1:2]) & (high >= classes[:, :1]))
    mine, other = size_class(n)[0], classes[c, 0]
    pair = (np.minimum(mine, other) << 32 | np.maximum(mine, other)).astype(np.uint64)
    return mixed(mixed(shared[k].view(np.uint64) + pair) * _TAG + pair), np.where(mine == other, -1, mine < other)


def _finer(nodes: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(band, fp, n, side) of the nodes (fp, n): two whose sets are that similar share a value of ``band``, on both sides if it has any, unlike ones with a common part seldom do."""

    def each(batches):
        for batch in batches:
            fps, counts = batch.column(0), batch.column(1).to_numpy()
            for lo, hi in slices(np.append(0, np.cumsum(counts, dtype=np.int64)), 1 << 16):
                told = [[batch.column(c)[i].values.to_numpy() for c in (2, 3, 4)] for i in range(lo, hi)]
                values, sides = zip(*[prefix_values(int(n), int(n) - len(of[0]), *of, least) for n, of in zip(counts[lo:hi], told)])
                at, side = np.repeat(np.arange(lo, hi), [len(v) for v in values]), np.concatenate(sides)
                columns = [pa.array(np.concatenate(values).view(np.int64)), fps.take(pa.array(at)), pa.array(counts[at], pa.int32()), pa.array(side, pa.int32(), mask=side < 0)]
                yield pa.RecordBatch.from_arrays(columns, names=["band", "fp", "n", "side"])

    own = stored(sets.join(nodes, "fp").select("fp", "n", F.explode("shingles").alias("shingle")), "own")
    often = own.groupBy("shingle").agg(F.count("*").alias("count"), F.min("n").alias("low"), F.max("n").alias("high")).where("count > 1")
    order = F.sort_array(F.collect_list(F.struct("count", "shingle", "low", "high")))
    told = own.drop("n").join(often, "shingle").groupBy("fp").agg(order.alias("o")).join(nodes, "fp")
    found = modest_batches(told.select("fp", "n", "o.shingle", "o.low", "o.high")).mapInArrow(each, "band long, fp binary, n int, side int")
    return stored(found, "finer")


def groups(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, th, fp, n, bands) of all documents, and (fp, root) of the sets that are linked with others, None if none is; both stored."""
    rows = stored(_nodes(docs, words), "nodes")
    one = rows.where("n > 0").groupBy("fp").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    members = stored(one.select("fp", F.col("n").cast("int").alias("n"), F.posexplode("bands").alias("place", "band")), "members")
    shared = members.groupBy("band").count().where("count > 1").select("band")
    active = stored(members.join(shared, "band"), "shared")
    if active.isEmpty():
        return rows, None
    wanted = rows.join(active.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.min(F.struct(F.col("th").alias("hash"), F.col("doc_id").alias("id"))).alias("row"))
    sets = stored(_sets(docs, stored(wanted.select("fp", "row.*"), "wanted"), words), "sets")
    labels, left = None, []
    for lo, hi in ROUNDS:
        bands = active.where(F.col("place").between(lo, hi - 1)).select("band", "fp", "n", F.lit(None).cast("int").alias("side"))
        rest, labels = _pivoted(bands, labels, sets, least, TURNS)
        left.append(rest)
    rest, labels = _pivoted(reduce(DataFrame.unionByName, left), labels, sets, least, 0)
    if not rest.isEmpty():
        labels = _pivoted(_finer(rest.select("fp", "n").distinct(), sets, least), labels, sets, least)[1]
    return rows, labels


def near_groups(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows, labels = groups(docs, words, least)
    sized = rows.select("doc_id", "fp", F.col("n").alias("n_shingles"))
    lows = sized.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("low"))
    if labels is not None:
        told = stored(lows.join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"), "rooted")
        lows = told.join(told.groupBy("root").agg(F.min("low").alias("least")), "root").select("fp", F.col("least").alias("low"))
    found = sized.join(stored(lows, "lows"), "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
