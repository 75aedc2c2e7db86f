"""Byte-pair encoding with the tokenizers library, one call for each distinct word a worker meets.

A text is cut where no pre-token can cross: before a space that a
non-space follows, and at line ends. What lies between recurs often, so its ids
are kept in a memo of bounded size; whatever the memo does not hold is encoded
by the library itself. Ids are little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

MEMO_ROWS = 500_000  # entries of a memo; later words are encoded each time they occur
MEMO_CHARS = 64  # longer words are not kept


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


# Latin letters, of which every table of letters says so: a run of them is one pre-token
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_letters() -> dict[int, int]:
    """The printable stand-ins of a byte-level vocabulary: visible Latin-1 characters for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_STAND_INS = _byte_letters()


def packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class _Words(dict):
    """Ids of a word that follows ``before`` (a space or nothing)."""

    def __init__(self, tok, before: str):
        super().__init__()
        self.tok, self.model, self.before = tok, tok.model, before
        self.ends = {c: packed(tok.encode(c, add_special_tokens=False).ids) for c in ",."}
        self.inner = None

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in self.ends and word[:-1].isalpha():
            ids = self[word[:-1]] + self.ends[word[-1]]
        elif self.inner is not None and "\n" in word and re.fullmatch(r"\S+(?:\n\S+)+", word):
            head, *rest = word.split("\n")
            ids = self[head] + b"".join(self.inner.line + self.inner[x] for x in rest)
        elif _LETTERS.fullmatch(word):  # the model alone; there is nothing to cut
            ids = packed([t.id for t in self.model.tokenize((self.before + word).encode().decode("latin-1").translate(_STAND_INS))])
        else:
            ids = packed(self.tok.encode(self.before + word, add_special_tokens=False).ids)
        if len(self) < MEMO_ROWS and len(word) <= MEMO_CHARS:
            self[word] = ids
        return ids


class ByteBpe:
    """Encoder for a byte-level vocabulary whose pre-tokens take at most one leading space."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.after, self.first = _Words(self.tok, " "), _Words(self.tok, "")
        self.first.line = packed(self.tok.encode("\n", add_special_tokens=False).ids)
        self.after.inner = self.first.inner = self.first
        self.loose = re.compile(r" (?=\s|$)")
        self.cut = re.compile(r" (?=\S)")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = self.cut.split(text) if self.loose.search(text) else text.split(" ")
        return (self.first[head] if head else b"") + b"".join(map(self.after.__getitem__, rest))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each worker process, kept from task to task."""
    return ByteBpe(path)
