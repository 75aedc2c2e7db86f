"""Repeated windows over a whole corpus, as Spark jobs on runs.

1. Runs of all texts (see ``runs``) are stored: one small row per run.
2. Anchors that a single place has are dropped by a pre-aggregated count.
3. Runs whose whole region repeats are settled by a count per region.
4. What is left lies at the edges of repeated passages. Of each distinct region
   one representative is fetched from its text, and the regions of an anchor are
   compared in one task by the operator's own method. Anchors with more than
   ``HOT`` regions are first cut into finer runs, again and again, until their
   groups are small or every window is settled by a count.

A frequent passage never meets in one task: its runs are counted before the
shuffle, and its rows meet the counts in equi-joins that adaptive execution
splits.

Rules: "earlier" asks for a window that starts in a document with a smaller
order number, "other" for one that starts anywhere else.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import runs as R
from tallyloom.llm.common import keyed_texts, modest_batches, slices, stored, utf8

HOT = 256  # regions of an anchor that one task compares
LAST = (1 << 63) - 1  # order number of a null doc_id
RUN = "o long, th long, first long, n int, at int, h long, r long"
# h0 and r0 name the run a region belongs to; ``first`` counts from the start of that run
REGION = "o long, first long, n int, at int, h long, r long, h0 long, r0 long, target boolean, region binary"
REGION_SCHEMA = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in REGION.split(", "))])
SPAN = "o long, h0 long, r0 long, lo long, hi long"


def ordered_texts(docs: DataFrame) -> DataFrame:
    """o (doc_id, null last), th and text of every document."""
    return keyed_texts(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("o"), "th", "text")


def _runs(texts: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    def find(batches):
        for batch in batches:
            o, th = (np.asarray(batch.column(i)) for i in (0, 1))
            data, offsets = utf8(batch.column(2))
            for lo, hi in slices(offsets, 4 << 20):
                parts = [data[offsets[i] : offsets[i + 1]] for i in range(lo, hi)]
                if kind == "words":
                    parts = [R.word_units(p) for p in parts]
                for x in R.window_runs(parts, width, gram, R.byte_units if kind == "bytes" else None):
                    d = x["doc"] + lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (o[d], th[d], x["first"], x["n"].astype(np.int32), (x["at"] - x["first"]).astype(np.int32), x["h"], x["r"])],
                        names=["o", "th", "first", "n", "at", "h", "r"],
                    )

    return modest_batches(texts).select("o", "th", "text").mapInArrow(find, RUN)


def _regions(texts: DataFrame, edges: DataFrame, kind: str, width: int) -> DataFrame:
    """The units of each representative's region."""

    def cut(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            out = []
            for i, runs in enumerate(batch.column(3).to_pylist()):
                units = data[offsets[i] : offsets[i + 1]]
                if kind == "words":
                    units = R.word_units(units)
                for run in runs:
                    region = units[run["first"] : run["first"] + run["n"] - 1 + width].tobytes()
                    out.append(run | {"o": batch.column(0)[i].as_py(), "first": 0, "h0": run["h"], "r0": run["r"], "region": region})
            yield pa.RecordBatch.from_pylist(out, schema=REGION_SCHEMA)

    lists = stored(edges.groupBy("o", "th").agg(F.collect_list(F.struct("first", "n", "at", "h", "r", "target")).alias("runs")), "edges")
    joined = texts.join(lists, ["o", "th"]).select("o", "th", "text", "runs")
    return modest_batches(joined, 500).mapInArrow(cut, REGION)


def _settled(rule: str):
    """Whether the region of a row repeats, from ``n_r`` (rows with it) and ``o_r`` (their least order number)."""
    return F.col("n_r") > 1 if rule == "other" else F.col("o") > F.col("o_r")


def _span(width: int, *keys: str):
    return ["o", *keys, F.col("first").alias("lo"), (F.col("first") + F.col("n") - 1 + width).alias("hi")]


def _compared(regions: DataFrame, compare: Callable, width: int) -> DataFrame:
    """Spans found by ``compare`` among the regions of each anchor; an anchor's regions lie in one task, next to each other."""

    def each(batches):
        held, key = [], None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["h"] != key:
                    if len(held) > 1:
                        out += compare(held, width)
                    held, key = [], row["h"]
                held.append(row)
            if out:
                yield _spans(out)
        if len(held) > 1 and (out := compare(held, width)):
            yield _spans(out)

    return modest_batches(regions.repartition("h").sortWithinPartitions("h", "o", "h0", "r0", "first")).mapInArrow(each, SPAN)


def _spans(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], names=["o", "h0", "r0", "lo", "hi"])


def _split(regions: DataFrame, kind: str, width: int, step: int) -> DataFrame:
    def each(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                units = np.frombuffer(row["region"], np.uint8 if kind == "bytes" else np.uint64)
                hashed = R.byte_units(units) if kind == "bytes" else units
                for first, n, h, r in R.split_runs(hashed, row["at"], row["n"], row["h"], width, step):
                    out.append(row | {"first": row["first"] + first, "n": n, "at": row["at"] - first, "h": h, "r": r, "region": units[first : first + n - 1 + width].tobytes()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=REGION_SCHEMA)

    return regions.mapInArrow(each, REGION)


def _hot_spans(regions: DataFrame, rule: str, kind: str, width: int, step: int, compare: Callable) -> list[DataFrame]:
    """Spans of regions whose anchors have more than HOT of them."""
    step = -(-step // 8)
    parts = stored(_split(regions, kind, width, step), "parts")
    name = F.struct("o", "h0", "r0", "first")
    rep = F.min(name).alias("rep")
    per = stored(parts.groupBy("h", "r").agg(F.count("*").alias("n_r"), F.min("o").alias("o_r"), rep), "part_regions")
    told = parts.join(per, ["h", "r"])
    found = [told.where(_settled(rule) & F.col("target")).select(*_span(width, "h0", "r0"))]
    if step == 1:
        return found
    kept = told.where(name == F.col("rep") if rule == "other" else F.col("o") == F.col("o_r")).withColumn("target", F.col("target") & ~_settled(rule))
    return found + _edge_spans(stored(kept.select(*parts.columns), "part_edges"), rule, kind, width, step, compare)


def _edge_spans(regions: DataFrame, rule: str, kind: str, width: int, step: int, compare: Callable) -> list[DataFrame]:
    """Spans (o, h0, r0, lo, hi) among the regions of each anchor, counted from the start of the run."""
    sizes = stored(regions.groupBy("h").agg(F.count("*").alias("regions")).where("regions > 1"), "anchors")
    told = regions.join(sizes, "h")
    found = [_compared(told.where(F.col("regions") <= HOT).drop("regions"), compare, width)]
    if not sizes.where(F.col("regions") > HOT).isEmpty():
        found += _hot_spans(told.where(F.col("regions") > HOT).drop("regions"), rule, kind, width, step, compare)
    return found


def repeated_spans(texts: DataFrame, rule: str, kind: str, width: int, gram: int, compare: Callable) -> DataFrame:
    """(o, th, spans): per document with any, the stretches of units that repeated windows cover, as an unordered list of lo, hi."""
    runs = stored(_runs(texts, kind, width, gram), "runs")
    several = F.count("*") > 1 if rule == "other" else F.min("o") < F.max("o")
    anchors = stored(runs.groupBy("h").agg(several.alias("several"), (F.min("r") < F.max("r")).alias("many")).where("several").select("h", "many"), "anchors")
    shared = stored(runs.join(anchors, "h"), "shared")
    rep = F.min(F.struct("o", "th", "first", "n", "at")).alias("rep")
    blocks = stored(shared.groupBy("h", "r").agg(F.count("*").alias("n_r"), F.min("o").alias("o_r"), F.max("o").alias("o_max"), F.max("many").alias("many"), rep), "regions")
    repeated = blocks.where(F.col("n_r") > 1 if rule == "other" else F.col("o_r") < F.col("o_max")).select("h", "r", "n_r", "o_r")
    spans = shared.join(repeated, ["h", "r"]).where(_settled(rule)).select(*_span(width, "th"))
    edges = blocks.where("many").select("rep.*", "h", "r", (F.col("n_r") == 1 if rule == "other" else F.lit(True)).alias("target"))
    regions = stored(_regions(texts, edges, kind, width), "edge_regions")
    for at_edges in _edge_spans(regions, rule, kind, width, width - gram + 1, compare):
        # a run may stand several times in its document: each place gets the spans of the one that was compared;
        # the spans take many times their files' size in memory, so they are not broadcast
        placed = shared.join(stored(at_edges, "edge_spans").withColumnsRenamed({"h0": "h", "r0": "r"}).hint("merge"), ["h", "r", "o"])
        spans = spans.unionByName(placed.select("o", "th", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi")))
    return stored(spans.groupBy("o", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal stretches, in order."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]
