"""Plain reference versions of the training-data operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def crc_ids(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def earlier_windows(docs, width):
    """{position of the row: (words, covered flags)} of rows (doc_id, text)."""
    words = [(t or "").encode().split() for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        order = (d is None, d or 0)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, order), order)
    out = []
    for (d, _), w in zip(docs, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < (d is None, d or 0):
                gone[i : i + width] = [True] * width
        out.append((d, w, gone))
    return out


def repeated_words(texts, width):
    """(words, covered flags) of every text: words in windows that start more than once."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((w, gone))
    return out


def repeated_bytes(docs, width):
    texts = [(t or "").encode() for _, t in docs]
    seen = defaultdict(int)
    for t in texts:
        for i in range(len(t) - width + 1):
            seen[t[i : i + width]] += 1
    out = []
    for (d, _), t in zip(docs, texts):
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, words):
    import xxhash

    w = low(text).encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def groups_of(prints, most):
    """Least id reachable, for (id, fingerprint) rows; and the number of groups."""
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= most:
                root[find(i)] = find(j)
    low_id = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low_id[find(i)] = min(low_id.get(find(i), d), d)
    return [low_id.get(find(i)) for i in range(n)], len({find(i) for i in range(n)})


def shingle_sets(texts, words):
    """Distinct shingles; fewer words: the whole sequence; no words: none."""
    out = []
    for t in texts:
        w = low(t).encode().split()
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    return out


def near_groups(sets, least):
    """For each set the positions of its group: those linked, over all pairs, by 100 * shared >= least * all; empty sets alone."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * min(len(a), len(b)) >= least * max(len(a), len(b)) and 100 * len(a & b) >= least * len(a | b):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(sets)):
        out[find(i)].append(i)
    return [out[find(i)] for i in range(len(sets))]


def runs(w, least):
    """(start, length, period) of every run, from all periods."""
    n, out = len(w), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, 2 * q) and all(any(w[k] != w[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def lyndon(w):
    """Length of the longest Lyndon word at each position."""
    return [max(j - i for j in range(i + 1, len(w) + 1) if all(w[i:j] < w[k:j] for k in range(i + 1, j))) for i in range(len(w))]


def divergence(rows, least_docs, top):
    """{(lang, source, part, item, value, rank)} of rows (lang, source, text)."""
    docs, occurs = Counter(), Counter()
    groups = {((a or ""), (b or "")) for a, b, _ in rows}
    for lang, source, text in rows:
        found = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", low(text))
        docs.update({(lang or "", t) for t in found})
        occurs.update((lang or "", source or "", t) for t in found)
    out = set()
    for lang in {a for a, _ in groups}:
        kept = [t for (a, t), n in docs.items() if a == lang and n >= least_docs]
        sources = [b for a, b in groups if a == lang]
        counts = {s: {t: occurs[lang, s, t] for t in kept} for s in sources}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()}
        q = share(whole)
        for s in sources:
            p = share(counts[s])
            pair = [(sum(abs(p[t] - x) for t, x in share(counts[o]).items()), o) for o in sources if o != s]
            term = [(p[t] - q[t], t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, r) for r, (value, item) in enumerate(ranked, 1) if part == "pair" or r <= top}
    return out
