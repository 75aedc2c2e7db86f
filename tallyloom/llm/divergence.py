"""How the sources of a language differ in their terms, exactly, over a frequent-pattern tree.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased);
a language keeps those in at least ``least_docs`` of its documents. A source's
share of a term is p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)): V kept terms,
N occurrences of them in the source. Two sources differ by the sum of |p - q|
over all kept terms.

Most terms are absent from most sources, so absent counts are never listed. With
z the share of a term that a source lacks, V * |z_a - z_b| is the sum if all were
absent; terms that a holds add |p - z_b| - |z_a - z_b|, from a count of a's shares;
and terms that both hold add |p - q| - |p - z_b| - |z_a - q| + |z_a - z_b|. The
last comes from the tree: every term is a path of its (source, p) in source order,
equal terms are one path with a multiplicity, and paths with a common beginning
share its nodes. A node's multiplicity is the number of terms below it, and every
combination of a node with one of its ancestors is corrected once, times that.

Paths are counted before they are shuffled, dealt by ranges and read in order, so
that a task holds the open path alone and no tree is gathered; a node that two
tasks share is corrected in parts. Texts are counted where they lie, and only
counts per (language, term, source) are shuffled; no group of rows meets in one task.

Null text, lang and source count as ''. Every (lang, source) that occurs is
audited, with 0 everywhere if its language keeps no term. Rows that repeat are
documents of their own; doc_ids and other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import modest_batches, stored, utf8

LEAST_DOCS, TOP_TERMS = 30, 50
HELD = 400_000  # counts of terms that a task gathers before it hands them on
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PATH = "array<struct<source:string,p:bigint,z:bigint>>"


def terms(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text; letters beyond ASCII have bytes from 128 on."""
    return text.translate(_FOLD).split()


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), several rows for a term; a group has a row without a term too."""

    def batch_of(found: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, n, held[term]) for (lang, source), (occurs, held) in found.items() for term, n in occurs.items()]
        rows += [(lang, source, None, 0, 0) for lang, source in found]
        lang, source, term, n, held = zip(*rows)
        words = pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), words, pa.array(n, pa.int64()), pa.array(held, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def each(batches):
        found: dict = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                words = terms(data[offsets[i] : offsets[i + 1]].tobytes())
                occurs, held = found[key]
                occurs.update(words)
                held.update(set(words))
                if i % 64 == 63 and sum(len(x) for x, _ in found.values()) > HELD:
                    yield batch_of(found)
                    found.clear()
        if found:
            yield batch_of(found)

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return modest_batches(texts).mapInArrow(each, "lang string, source string, term string, n long, docs long")


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10**9 * (count + 5) / (n + 5 * v)) without overflow."""
    wide = lambda c: c.cast("decimal(19,0)")
    scaled = F.lit(10**9).cast("decimal(10,0)") * (wide(count) + F.lit(5).cast("decimal(1,0)"))
    whole = wide(n) + F.lit(5).cast("decimal(1,0)") * wide(v)
    return F.call_function("div", scaled, whole) + F.lit(1).cast("long")


class PathTree:
    """Paths with multiplicities, in ascending order; only the open path is held."""

    def __init__(self):
        self.open: list[list] = []  # [(source, p, z), terms below]
        self.sums: dict[tuple[str, str], int] = defaultdict(int)

    def close(self, depth: int) -> None:
        """Leave the nodes below ``depth``, correcting each with its ancestors."""
        while len(self.open) > depth:
            (b, q, zb), times = self.open.pop()
            for (a, p, za), _ in self.open:
                self.sums[a, b] += times * (abs(p - q) - abs(p - zb) - abs(za - q) + abs(za - zb))
            if self.open:
                self.open[-1][1] += times

    def add(self, path: list[tuple[str, int, int]], times: int) -> None:
        depth = 0
        while depth < min(len(path), len(self.open)) and self.open[depth][0] == path[depth]:
            depth += 1
        self.close(depth)
        self.open += [[node, 0] for node in path[depth:]]
        self.open[-1][1] += times


def _corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, value), several rows for a pair, of paths (lang, path, times)."""

    def batch_of(lang: str, tree: PathTree) -> pa.RecordBatch:
        a, b = zip(*tree.sums)
        columns = [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(list(tree.sums.values()), pa.int64())]
        tree.sums.clear()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    def each(batches):
        now, tree = None, PathTree()
        for batch in batches:
            for lang, path, times in zip(*[c.to_pylist() for c in batch.columns]):
                if lang != now or len(tree.sums) > HELD:
                    tree.close(0)
                    if tree.sums:
                        yield batch_of(now, tree)
                    now = lang
                tree.add([(x["source"], x["p"], x["z"]) for x in path], times)
        tree.close(0)
        if tree.sums:
            yield batch_of(now, tree)

    # ranges by the beginning of a path, of which the driver samples a few rows, and a hash that splits frequent beginnings
    ordered = paths.repartitionByRange("lang", F.slice("path", 1, 3), F.xxhash64("path")).sortWithinPartitions("lang", "path")
    return modest_batches(ordered.select("lang", "path", "times")).mapInArrow(each, "lang string, a string, b string, value long")


def _pairs(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    one = sizes.select("lang", F.col("source").alias("a"), F.col("z").alias("za"), "v")
    two = sizes.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    absent = one.join(two, "lang").where("a <> b").select("lang", "a", "b", F.coalesce(F.col("v") * F.abs(F.col("za") - F.col("zb")), F.lit(0)).alias("value"))
    shares = rows.groupBy("lang", F.col("source").alias("a"), "p", F.col("z").alias("za")).agg(F.count("*").alias("times"))
    single = shares.join(two, "lang").where("a <> b")
    single = single.groupBy("lang", "a", "b").agg(F.sum(F.col("times") * (F.abs(F.col("p") - F.col("zb")) - F.abs(F.col("za") - F.col("zb")))).alias("value"))
    terms_ = rows.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("path"))
    paths = stored(terms_.groupBy("lang", "path").agg(F.count("*").alias("times")), "paths")
    both = _corrections(paths)
    turned = lambda df: df.unionByName(df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    parts = absent.unionByName(turned(single)).unionByName(turned(both))
    return parts.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows to every other source, ``term`` rows of the ``top`` terms a source uses more than its language."""
    counts = stored(_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    held = F.collect_list(F.struct("source", "n")).alias("held")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), held).where(F.col("docs") >= least_docs)
    kept = stored(kept.select("lang", "term", "all", "held"), "kept_terms")
    entries = kept.select("lang", "term", "all", F.inline("held"))
    occurs = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("n_lang"))
    groups = counts.where("term IS NULL").select("lang", "source")
    sizes = groups.join(occurs, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "v", "n_lang")
    sizes = stored(sizes.withColumn("z", _share(F.lit(0), F.col("n"), F.col("v"))), "sizes")
    known = entries.join(sizes.withColumnRenamed("n", "total"), ["lang", "source"])
    rows = known.select("lang", "source", "term", "z", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("all"), F.col("n_lang"), F.col("v")).alias("q"))
    rows = stored(rows, "shares")
    above = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pair = _pairs(rows, sizes).withColumn("rank", F.row_number().over(order))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(*out).unionByName(term.withColumn("part", F.lit("term")).select(*out))
