"""Substring deduplication by relative Lempel-Ziv parsing.

A document is parsed against the reference blocks of all documents before it
(smaller doc_id): greedily, the longest stretch from the current word that a
block holds is a factor, and the parse goes on behind it. Factors of at least
``width`` words are duplicate spans. A window of ``width`` words that crosses
the boundary of two factors can still occur as a whole in some block, so the
windows at boundaries are looked up one by one in the blocks' window index.

Blocks are the regions of ``runs``: content-defined, so that a block of a
document equal to a block before it is a factor of whole windows and is settled
without a comparison; blocks that are left are parsed against all blocks that
share their anchor, wherever equal windows can be.

Windows are judged on the input. Null text has no words. A null doc_id sorts
after all others; rows that share a doc_id are one document to each other, so
none is before the other. Documents of fewer than ``width`` words, empty texts
and empty tables lose nothing. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import modest_batches, utf8
from tallyloom.llm.repeats import LAST, merged, ordered_texts, repeated_spans

WIDTH, GRAM = 50, 12


class Reference:
    """Blocks of words with an index of their grams and of their windows."""

    def __init__(self, width: int, gram: int):
        self.width, self.gram = width, gram
        self.blocks: list[list[int]] = []
        self.places: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        self.windows: set[tuple] = set()

    def add(self, words: list[int]) -> None:
        block = len(self.blocks)
        self.blocks.append(words)
        for i in range(len(words) - self.gram + 1):
            self.places[tuple(words[i : i + self.gram])].append((block, i))
        self.windows.update(tuple(words[i : i + self.width]) for i in range(len(words) - self.width + 1))

    def factor(self, words: list[int], at: int) -> int:
        """Length of the longest stretch from ``at`` that a block holds, 0 if shorter than a gram."""
        best = 0
        for block, i in self.places.get(tuple(words[at : at + self.gram]), ()):
            held, n = self.blocks[block], 0
            most = min(len(words) - at, len(held) - i)
            if most <= best or held[i + best] != words[at + best]:
                continue
            while n < most and held[i + n] == words[at + n]:
                n += 1
            best = max(best, n)
        return best

    def parse(self, words: list[int]) -> list[tuple[int, int]]:
        """Greedy factors (start, length); a word that no block continues is a factor of length 1."""
        at, out = 0, []
        while at < len(words):
            n = max(1, self.factor(words, at))
            out.append((at, n))
            at += n
        return out

    def covered(self, words: list[int]) -> list[tuple[int, int]]:
        """Stretches that windows of the reference cover."""
        if not self.blocks:
            return []
        out, inside = [], set()
        for at, n in self.parse(words):
            if n >= self.width:
                out.append((at, at + n))
                inside.update(range(at, at + n - self.width + 1))
        for i in range(len(words) - self.width + 1):
            if i not in inside and tuple(words[i : i + self.width]) in self.windows:
                out.append((i, i + self.width))
        return out


def compare(regions: list[dict], width: int, gram: int = GRAM) -> list[tuple[int, int, int, int, int]]:
    """Spans of the regions of one anchor, each parsed against those of smaller order numbers; they come in that order."""
    reference, waiting, out = Reference(width, gram), [], []
    for x in sorted(regions, key=lambda x: x["o"]):
        words = np.frombuffer(x["region"], np.uint64).tolist()
        if waiting and waiting[0][0] != x["o"]:
            for _, earlier in waiting:
                reference.add(earlier)
            waiting = []
        out += [(x["o"], x["h0"], x["r0"], x["first"] + a, x["first"] + b) for a, b in reference.covered(words)]
        waiting.append((x["o"], words))
    return out


def removed(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (lo, hi in words), kept_text."""

    def finish(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            out = []
            for i, (o, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                text = data[offsets[i] : offsets[i + 1]]
                words, gone = text.tobytes().split(), merged(spans)
                edges = [0, *[e for pair in gone for e in pair], len(words)]
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                out.append((None if o == LAST else o, len(words), len(words) - len(kept), [{"lo": a, "hi": b} for a, b in gone], b" ".join(kept).decode()))
            cols = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    texts = ordered_texts(docs)
    spans = repeated_spans(texts, "earlier", "words", width, gram, partial(compare, gram=gram))
    joined = texts.join(spans, ["o", "th"], "left").select("o", "text", "spans")
    return modest_batches(joined).mapInArrow(finish, "doc_id long, n_words long, n_removed long, spans array<struct<lo:bigint,hi:bigint>>, kept_text string")
