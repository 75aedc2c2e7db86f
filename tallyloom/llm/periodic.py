"""Periodic runs of words, found through Lyndon roots.

A run is a stretch of consecutive words with smallest period q and at least
``max(least, 2 * q)`` words that no neighbouring word extends keeping the period.
Every run holds a Lyndon root: at some position of its first period the longest
Lyndon word, under some order of the words or under the reversed order, has the
length q. The longest Lyndon words of all positions are what the first phase of
Baier's suffix sorter yields: positions are grouped by their first word, groups
are taken from the highest down, and every group moves the positions that precede
its members and lie lower into new groups behind their old ones, whose contexts
grow by the context of the group. Both orders give candidates; longest common
extensions to both sides, by hashes and then confirmed word by word, make them
runs.

The two halves of a run, or of a part of it, agree in ``least // 2`` words one
period apart, so every word of a run lies in a sequence of that many words that
the document holds twice. Stretches of such words are looked at alone; they are
separated by marks lower than all words, each its own, that no run crosses.

Each document is handled by itself, in one pass without a shuffle. Null text
counts as no words; documents of fewer than ``least`` words have no runs.
Repeated rows and null doc_ids are documents like others. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import modest_batches, slices, texts_of, utf8
from tallyloom.llm.runs import mixed, prefix_hash, stretch_hash

LEAST = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each position, by the grouping phase of the suffix sorter.

    A group is named by its first place in the order of all groups, so names
    compare like groups; ``closing`` finds the group that ends at a place.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    begins = np.flatnonzero(np.diff(ranks[order], prepend=-1))
    sizes = np.diff(np.append(begins, n))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(begins, sizes)
    group, out, before = group.tolist(), [0] * n, [-1] * n
    members = {b: order[b : b + z].tolist() for b, z in zip(begins.tolist(), sizes.tolist())}
    size = {b: len(m) for b, m in members.items()}
    closing = {b + z: b for b, z in size.items()}
    context = dict.fromkeys(members, 1)
    end = n
    while end:
        g = closing[end]
        u, pointed = context[g], {}
        for i in sorted(members.pop(g)):
            if group[i] != g:
                continue
            out[i] = u
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            parts.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(parts, reverse=True):
            moved = parts[times, old]
            last = old + size[old]
            new = last - len(moved)
            context[new] = context[old] + times * u
            if new != old:
                size[old], size[new] = new - old, len(moved)
                closing[last], closing[new] = new, old
                members[new] = moved
                for j in moved:
                    group[j] = new
        end = g
    return np.array(out, np.int64)


def _common(prefix: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """Equal symbols from i and j on, to the right (step 1) or before them to the left (-1), ``room`` at most."""
    found = np.zeros(len(i), np.int64)
    for bit in reversed(range(int(room.max(initial=0)).bit_length())):
        more = found + (1 << bit)
        fits = np.flatnonzero(more <= room)
        a, b, m = i[fits], j[fits], more[fits]
        x, y = (a, b) if step == 1 else (a - m, b - m)
        same = stretch_hash(prefix, x, x + m, 0) == stretch_hash(prefix, y, y + m, 0)
        found[fits[same]] = m[same]
    return found


def _is_run(ids: np.ndarray, s: int, e: int, p: int) -> bool:
    return np.array_equal(ids[s : e - p], ids[s + p : e]) and (s == 0 or ids[s - 1] != ids[s - 1 + p]) and (e == len(ids) or ids[e] != ids[e - p])


def _stretches_of_period(ids: np.ndarray, p: int, least: int) -> list[tuple[int, int]]:
    """First and last+1 of every maximal stretch of at least ``least`` and two periods whose smallest period is p, word by word."""
    edge = np.diff(np.concatenate(([0], (ids[p:] == ids[:-p]).astype(np.int8), [0])))
    both = zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + p).tolist())
    parts = [q for q in range(1, p // 2 + 1) if p % q == 0]  # a smaller period of two periods divides them
    return [(s, e) for s, e in both if e - s >= max(least, 2 * p) and not any(np.array_equal(ids[s : e - q], ids[s + q : e]) for q in parts)]


def find_runs(ids: np.ndarray, marks: int = 0, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run; ids are dense ranks from 0 and those under ``marks`` are separators that occur once."""
    n = len(ids)
    if n < least:
        return []
    orders = ids, np.where(ids < marks, ids, marks + ids.max() - ids)
    at, period = np.tile(np.arange(n), 2), np.concatenate([lyndon_lengths(x) for x in orders])
    some = np.flatnonzero(at + period < n)
    some = some[ids[at[some]] == ids[at[some] + period[some]]]  # a root in the first period is followed by its own first word
    pairs = np.unique(np.column_stack((at[some], period[some])), axis=0)
    i, p = pairs[:, 0], pairs[:, 1]
    prefix = prefix_hash(mixed(ids.astype(np.uint64) + _BASE), 0)
    right = _common(prefix, i, i + p, n - i - p, 1)
    left = _common(prefix, i, i + p, i, -1)
    start, end = i - left, i + p + right
    long = end - start >= np.maximum(least, 2 * p)
    found = np.unique(np.column_stack((start, end, p))[long], axis=0).tolist()
    wrong = {p for s, e, p in found if not _is_run(ids, s, e, p)}  # equal hashes of unequal words
    out = [(s, e - s, p) for s, e, p in found if p not in wrong]
    for p in wrong:
        out += [(s, e - s, p) for s, e in _stretches_of_period(ids, p, least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _recurring(units: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Maximal stretches covered by sequences of ``gram`` words that occur again."""
    m = len(units) - gram + 1
    if m < 2:
        return []
    h = units[:m].copy()
    for k in range(1, gram):
        h = h * _BASE + units[k : k + m]
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return []
    again = twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h
    edge = np.zeros(len(units) + 2, np.int64)
    where = np.flatnonzero(again)
    edge[where + 1] += 1
    edge[where + gram + 1] -= 1
    step = np.diff((np.cumsum(edge) > 0).astype(np.int8))
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))


def runs_of_documents(documents: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    held: list[tuple[int, int, int]] = []
    for d, words in enumerate(documents):
        if len(words) >= least:
            units = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
            held += [(d, lo, hi) for lo, hi in _recurring(units, least // 2) if hi - lo >= least]
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not held:
        return out
    names: dict[bytes, int] = {}
    ids: list[int] = []
    places, at = [], 0
    for k, (d, lo, hi) in enumerate(held):
        ids += [names.setdefault(w, len(held) + len(names)) for w in documents[d][lo:hi]]
        ids.append(k)
        places.append(at)
        at = len(ids)
    for start, length, period in find_runs(np.array(ids, np.int64), len(held), least):
        k = int(np.searchsorted(places, start, "right")) - 1
        d, lo, _ = held[k]
        out[d].append((start - places[k] + lo, length, period))
    return out


def without_repetitions(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """For a tenth of the ids, where a periodic end of n words begins and its period; null ids have none."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def collapsed(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed text.

    ``rewrite`` (doc_id, number of words) may give (a, p): each word i >= a is
    then taken to be word a + (i - a) % p.
    """

    def each(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in slices(offsets, 4 << 20):
                documents = [data[offsets[i] : offsets[i + 1]].tobytes().split() for i in range(lo, hi)]
                for k, words in enumerate(documents if rewrite else ()):
                    if change := rewrite(doc_ids[lo + k], len(words)):
                        a, p = change
                        part = words[a : a + p]
                        rest = len(words) - a
                        documents[k] = words[:a] + (part * (rest // p + 1))[:rest]
                runs = runs_of_documents(documents, least)
                flat = [r for some in runs for r in some]
                columns = [pa.array([r[c] for r in flat], pa.int64()) for c in range(3)]
                ends = np.cumsum([0] + [len(some) for some in runs]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(RUN)))
                texts = pa.array([without_repetitions(w, r) for w, r in zip(documents, runs)], pa.binary()).cast(pa.string())
                counts = pa.array([len(w) for w in documents], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), counts, lists, texts], names=["doc_id", "n_words", "runs", "collapsed"])

    return modest_batches(texts_of(docs)).mapInArrow(each, OUT)
