"""Substring deduplication with suffix arrays, sorted deep-shallow.

Every 400-byte string that starts more than once is found and the bytes that it
covers are removed, in all its places. The anchors of ``runs`` sample the
suffixes: two equal strings hold the same anchor at the same offset, so it is
enough to sort the suffixes that start at shared anchors. Equal anchors bring
suffixes together (their first ``GRAM`` bytes are equal); within an anchor the
suffixes of its distinct regions are sorted by multikey quicksort, eight bytes
at a time, to depth ``SHALLOW``, and groups that agree so far go into a blind
trie, which needs one comparison per suffix however long the common prefix is.
Neighbours in the suffix array give the right extents of common strings; the
left extents are compared as the walk leaves a suffix in both directions, and
it ends where the shared prefix gets too short for any window.

Null text counts as empty. Matches never cross documents. Rows equal in doc_id
and text repeat each other and get the same result; null doc_ids are documents
like others. Empty texts and tables give no spans. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import modest_batches, utf8
from tallyloom.llm.repeats import LAST, merged, ordered_texts, repeated_spans
from tallyloom.llm.runs import words_of

WIDTH, GRAM, SHALLOW = 400, 40, 64


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _blind_trie(strings: list[bytes], members: list[int], depth: int) -> list[int]:
    """Members in order of their strings, which agree up to ``depth``.

    A node is [depth, {byte: child}], a leaf a list of the members with one
    string. An insertion goes down by branching bytes alone, without looking at
    the bytes between, then compares once with the leaf it met.
    """
    byte = lambda s, d: s[d] if d < len(s) else -1
    root: list | None = None
    for m in members:
        s = strings[m]
        if root is None:
            root = [None, [m]]
            continue
        node = root
        while node[0] is not None:
            node = node[1].get(byte(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        d = depth + common_prefix(s[depth:], other[depth:])
        if d == len(s) == len(other):
            node[1].append(m)
            continue
        parent, node = None, root
        while node[0] is not None and node[0] < d:
            parent, node = node, node[1][byte(s, node[0])]
        if node[0] == d:
            node[1][byte(s, d)] = [None, [m]]
            continue
        fork = [d, {byte(s, d): [None, [m]], byte(other, d): node}]
        if parent is None:
            root = fork
        else:
            parent[1][byte(s, parent[0])] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] is None:
            out += node[1]
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Positions of the strings in ascending order."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        members, depth = stack.pop()
        if len(members) < 2:
            out += members
            continue
        if depth >= shallow:
            out += _blind_trie(strings, members, depth)
            continue
        keys = {m: strings[m][depth : depth + 8] for m in members}
        pivot = keys[members[len(members) // 2]]
        less = [m for m in members if keys[m] < pivot]
        same = [m for m in members if keys[m] == pivot]
        more = [m for m in members if keys[m] > pivot]
        stack.append((more, depth))
        if len(pivot) < 8:  # all end here
            stack += [([m], depth) for m in same]
        else:
            stack.append((same, depth + 8))
        stack.append((less, depth))
    return out


def _backwards(region: bytes, unit: int) -> bytes:
    return region[::-1] if unit == 1 else np.frombuffer(region, np.uint64)[::-1].tobytes()


def compare(regions: list[dict], width: int, unit: int = 1) -> list[tuple[int, int, int, int, int]]:
    """Spans of the target regions of one anchor whose windows other regions hold too; a unit has ``unit`` bytes."""
    right = [x["region"][x["at"] * unit :] for x in regions]
    left = [_backwards(x["region"][: x["at"] * unit], unit) for x in regions]
    order = deep_shallow_order(right)
    near = [common_prefix(right[a], right[b]) // unit for a, b in zip(order, order[1:])]
    out = []
    for k, i in enumerate(order):
        x = regions[i]
        if not x["target"]:
            continue
        low, high = x["at"] - x["n"] + 1, x["at"]  # offsets of the anchor in the windows
        for step in (1, -1):
            shared, j = width, k
            while True:
                j += step
                if not 0 <= j < len(order):
                    break
                shared = min(shared, near[j - 1] if step == 1 else near[j])
                if width - shared > high:
                    break
                a, b = max(low, width - shared), min(high, common_prefix(left[i], left[order[j]]) // unit)
                if a <= b:
                    out.append((x["o"], x["h0"], x["r0"], x["first"] + x["at"] - b, x["first"] + x["at"] - a + width))
    return out


def compare_words(regions: list[dict], width: int) -> list[tuple[int, int, int, int, int]]:
    """``compare`` for regions of eight-byte word hashes."""
    return compare(regions, width, 8)


def _with_spans(docs: DataFrame, width: int, gram: int, rows: DataFrame, kind: str = "bytes") -> DataFrame:
    """``rows`` (o, th and more) with the list of repeated stretches, null where there is none."""
    spans = repeated_spans(ordered_texts(docs), "other", kind, width, gram, compare if kind == "bytes" else compare_words)
    return rows.join(spans.hint("merge"), ["o", "th"], "left")  # many times their files' size in memory: not broadcast


def _kept(text: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    gone = merged(spans)
    edges = [0, *[e for pair in gone for e in pair], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), gone


def _kept_words(data: np.ndarray, spans) -> bytes:
    """The text without the words of the spans and the white space that follows each of them."""
    if not spans:
        return data.tobytes()
    first, _ = words_of(data)
    edge = np.append(first, len(data))
    return _kept(data.tobytes(), [{"lo": int(edge[s["lo"]]), "hi": int(edge[s["hi"]])} for s in spans])[0]


def removed(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans (lo, hi), kept_sha256."""

    def finish(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            out = []
            for i, (o, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                kept, gone = _kept(text, spans)
                out.append((None if o == LAST else o, len(text), len(text) - len(kept), len(gone), [{"lo": a, "hi": b} for a, b in gone], hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    joined = _with_spans(docs, width, gram, ordered_texts(docs)).select("o", "text", "spans")
    return modest_batches(joined).mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<lo:bigint,hi:bigint>>, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, kind: str = "bytes") -> DataFrame:
    """The documents with repeated stretches cut out of the text, other columns unchanged but ``n_chars``, the new length.

    ``kind`` is bytes or words: width and gram count these. Words are
    ``[^\\x20\\x09-\\x0D]+``, compared by 64-bit hashes; a removed word takes the
    white space after it along. Of bytes, a character that a cut splits goes as a whole.
    """

    def cut(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            texts = []
            for i, spans in enumerate(batch.column(1).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                kept = _kept_words(text, spans) if kind == "words" else _kept(text.tobytes(), spans)[0]
                texts.append(kept.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[2:]], names=["new", *batch.schema.names[2:]])

    lean = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("o"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.coalesce("text", F.lit("")).alias("text"), lean.alias("row"))
    joined = _with_spans(docs, width, gram, rows, kind).select("text", "spans", "row")
    rest = joined.schema["row"].dataType.simpleString()
    done = modest_batches(joined).mapInArrow(cut, f"new string, row {rest}")
    chosen = {"text": F.col("new"), "n_chars": F.length("new").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("new")}
    return done.select(*[chosen.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
