"""Content-defined runs of windows: where equal windows of many documents can be found without listing windows.

A window is ``width`` consecutive units (words or bytes) of one document. Each
window has an anchor, the unit sequence of length ``gram`` in it with the least
hash (the leftmost of equals); equal windows have equal anchors at equal
offsets. Consecutive windows with the same anchor form a run, whose region is
the union of its windows. Two runs can share a window only if their anchors
are equal; if their regions are equal too they share all.

``window_runs`` finds the runs of a batch of unit arrays, ``split_runs`` cuts a
region into finer runs around the same anchor, for anchors whose regions are
too many for one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK = 1 << 19  # units handled at once
_LOW = (1 << 24) - 1
_WIDE = 1 << 64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_RANDOM = np.random.default_rng(20).integers(1, _WIDE - 1, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers_to(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    base = pow(_BASES[which], -1, _WIDE) if inverse else _BASES[which]
    return _powers_to(base, max(n, CHUNK).bit_length())[:n]


def prefix_hash(units: np.ndarray, which: int) -> np.ndarray:
    """n+1 prefix sums of units[i] * base**i, from which the hash of any stretch follows."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(which, len(units)), out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, first: np.ndarray, last: np.ndarray, which: int) -> np.ndarray:
    """Hash of units[first:last], the same wherever the stretch lies."""
    return mixed((prefix[last] - prefix[first]) * powers(which, len(prefix), inverse=True)[first] + (last - first).astype(np.uint64))


def byte_units(data: np.ndarray) -> np.ndarray:
    return _RANDOM[data]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 byte of every word [^\\x20\\x09-\\x0D]+ of a text."""
    ink = np.zeros(len(data) + 2, np.int8)
    ink[1:-1] = ~_SPACE[data]
    step = np.diff(ink)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_units(data: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of a text; long texts are read in pieces that end between words."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        if end < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            while not len(spaces) and end < len(data):
                end = min(len(data), end + CHUNK)
                spaces = np.flatnonzero(_SPACE[data[at:end]])
            if end < len(data):
                end = at + int(spaces[-1]) + 1
        piece = data[at:end]
        first, last = words_of(piece)
        if len(first):
            out.append(stretch_hash(prefix_hash(byte_units(piece), 0), first, last, 0))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def _chunks(lengths: list[int], width: int) -> Iterator[list[tuple[int, int, int]]]:
    """(document, first unit, last+1) pieces, gathered to about CHUNK units; a longer document overlaps itself by a window less one."""
    held, size = [], 0
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= width:
            end = min(n, at + CHUNK)
            held.append((d, at, end))
            size += end - at
            if size >= CHUNK:
                yield held
                held, size = [], 0
            if end == n:
                break
            at = end - width + 1
    if held:
        yield held


def window_runs(documents: list[np.ndarray], width: int, gram: int, units=None) -> Iterator[dict[str, np.ndarray]]:
    """Runs of all documents: doc (position in the list), first (start of the first window), n (windows), at (anchor), h and r (hashes of anchor and region).

    ``units`` maps a piece of a document to its 64-bit units, if it does not hold them already.
    """
    w = width - gram + 1
    for chunk in _chunks([len(x) for x in documents], width):
        x = np.concatenate([documents[d][lo:hi] for d, lo, hi in chunk])
        x = units(x) if units else x
        sizes = np.array([hi - lo for _, lo, hi in chunk])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        one = prefix_hash(x, 0)
        every = np.arange(len(x) - gram + 1)
        grams = stretch_hash(one, every, every + gram, 0)
        anchor = (_least((grams & ~np.uint64(_LOW)) | every.astype(np.uint64), w) & np.uint64(_LOW)).astype(np.int64)
        inside = np.zeros(len(x) + 1, np.int8)
        inside[starts] += 1
        inside[ends - width + 1] -= 1
        windows = np.flatnonzero(np.cumsum(inside)[: len(anchor)] > 0)
        own = anchor[windows]
        new = np.ones(len(windows), bool)
        new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(windows)) - 1
        first, last = windows[begin], windows[stop]
        piece = np.searchsorted(starts, first, "right") - 1
        shift = np.array([lo for _, lo, _ in chunk])[piece] - starts[piece]
        yield {
            "doc": np.array([d for d, _, _ in chunk])[piece],
            "first": first + shift,
            "n": last - first + 1,
            "at": own[begin] + shift,
            "h": grams[own[begin]].view(np.int64),
            "r": stretch_hash(prefix_hash(x, 1), first, last + width, 1).view(np.int64),
        }


def split_runs(units: np.ndarray, at: int, n: int, h: int, width: int, step: int) -> Iterator[tuple[int, int, int, int]]:
    """Cut a region's run (anchor at ``at``, ``n`` windows) by the anchor's offset in the window, into parts of ``step`` offsets.

    Yields (first window, windows, h, r): h hashes what every window of the part
    must hold, so equal windows get equal h; r hashes the part's region.
    """
    one, two = prefix_hash(units, 0), prefix_hash(units, 1)
    low, high = at - n + 1, at  # offsets of the anchor in the windows of the run
    for part in range(low // step, high // step + 1):
        a, b = part * step, part * step + step - 1  # the part's offsets
        x, y = max(a, low), min(b, high)
        core = (at - a, at - b + width)
        first, last = at - y, at - x
        key = np.array([core[0], first]), np.array([core[1], last + width])
        c = stretch_hash(one, key[0], key[1], 0)[0]
        r = stretch_hash(two, key[0], key[1], 1)[1]
        tag = mixed(np.array([h], np.int64).view(np.uint64) + np.uint64(part * 2654435761 + step))[0]
        yield first, y - x + 1, int((c ^ tag).view(np.int64)), int(r.view(np.int64))
