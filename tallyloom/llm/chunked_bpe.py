"""Byte-pair encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last ``WINDOW`` bytes has its low
bits zero, so stretches shared by documents are cut alike wherever they stand.
A worker encodes a chunk once and keeps what it gave: the ids of the words
inside it and the open ends before its first and after its last separator. At a
join the open ends of both sides are put together and encoded again, over as
many chunks as have no separator, so that the seam agrees exactly with the
encoding of the whole text: no pre-token of the vocabulary crosses white space.
Words are kept in a memo too; a word met for the first time is encoded by the
tokenizers library. Both memos are bounded and live in the worker process, from
task to task; no text is shuffled.

Null text counts as empty and gives no ids. Repeated rows, null doc_ids and
very long texts need nothing special; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import runs as R
from tallyloom.llm.bpe import MEMO_CHARS, MEMO_ROWS, load, packed
from tallyloom.llm.common import modest_batches, slices, texts_of, utf8

WINDOW, MASK = 16, 63  # bytes hashed; chunks of 64 bytes or so
MEMO_CHUNKS = 60_000
_OPEN = re.compile("[ \n]")


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of UTF-8 bytes: content-defined, never inside a character, the last byte's included."""
    if len(data) <= WINDOW:
        return np.array([len(data)])
    sums = R.prefix_hash(R.byte_units(data), 0)
    first = np.arange(len(data) - WINDOW + 1)
    cut = R.stretch_hash(sums, first, first + WINDOW, 0) & np.uint64(MASK) == 0
    ends = np.flatnonzero(cut) + WINDOW
    ends = ends[ends < len(data)]
    return np.append(ends[(data[ends] & 0xC0) != 0x80], len(data))


class WordBpe:
    """Encoder for a vocabulary that drops white space and never crosses it."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.words: dict[str, tuple[bytes, str]] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.reused = 0

    def word(self, text: str) -> tuple[bytes, str]:
        """Ids, and their tokens joined by spaces, of text without space or line end."""
        got = self.words.get(text)
        if got is None:
            if text[-1:] in (",", ".") and text[:-1].isalpha() and self.ends_in_letter(text[:-1]):
                (a, s), (b, t) = self.word(text[:-1]), self.word(text[-1])
                got = a + b, f"{s} {t}"
            else:
                ids = self.tok.encode(text, add_special_tokens=False).ids
                got = packed(ids), self.tok.decode(ids, skip_special_tokens=False)
            if len(self.words) < MEMO_ROWS and len(text) <= MEMO_CHARS:
                self.words[text] = got
        return got

    def ends_in_letter(self, word: str) -> bool:
        """Whether the word, normalised, is letters alone; a mark at its end would be one pre-token with punctuation after it."""
        return word.isascii() or self.tok.normalizer is None or self.tok.normalizer.normalize_str(word).isalpha()

    def chunk(self, data: bytes) -> tuple:
        """(open start, ids, tokens, open end), or the text alone if it has no separator."""
        got = self.chunks.get(data)
        if got is not None:
            self.reused += 1
            return got
        head, *rest = _OPEN.split(data.decode())
        if rest:
            done = [self.word(w) for w in rest[:-1] if w]
            got = head, b"".join(x for x, _ in done), " ".join(t for _, t in done if t), rest[-1]
        else:
            got = (head,)
        if len(self.chunks) >= MEMO_CHUNKS:
            self.chunks.clear()
        self.chunks[data] = got
        return got

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[bytes, str]:
        """Ids and decoded text of a document, given its bytes and the ends of its chunks."""
        raw, ids, tokens, open_, at = data.tobytes(), [], [], "", 0

        def close(text):
            if text:
                i, t = self.word(text)
                ids.append(i)
                if t:
                    tokens.append(t)

        for end in ends.tolist():
            got = self.chunk(raw[at:end])
            at = end
            if len(got) == 1:
                open_ += got[0]
                continue
            close(open_ + got[0])
            if got[1]:
                ids.append(got[1])
            if got[2]:
                tokens.append(got[2])
            open_ = got[3]
        close(open_)
        return b"".join(ids), " ".join(tokens)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, vocab: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian uint32), decoded.

    ``decoded`` is what the library's ``decode(ids, skip_special_tokens=False)``
    gives for a vocabulary without a decoder: the tokens joined by spaces.
    """

    def each(batches):
        bpe = word_bpe(vocab)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets, 4 << 20):
                done = []
                for i in range(lo, hi):
                    text = data[offsets[i] : offsets[i + 1]]
                    done.append(bpe.encode(text, chunk_ends(text)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(i) // 4 for i, _ in done], pa.int64()), pa.array([i for i, _ in done], pa.binary()), pa.array([t for _, t in done], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return modest_batches(texts_of(docs)).mapInArrow(each, "doc_id long, n_tokens long, ids binary, decoded string")
