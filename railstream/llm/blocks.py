"""Arrow batches cut into blocks of bounded text, and vectorised hashes of words and shingles.

A word is a maximal run of bytes other than the six ASCII white-space characters, as in
``[^\\x20\\x09-\\x0D]+``. Hashes have 64 bits and are the same in every process. Work space is
about 100 bytes for each byte of a block; a block holds one text at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * _U(_STEP))


class _Powers:
    """Powers of the hash base and of its inverse, kept between blocks."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_blocks(batches: Iterator[pa.RecordBatch], text: str,
                limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.BinaryArray]]:
    """Slices of the batches with at most ``limit`` bytes of text (or one row), and their texts.

    A missing text is an empty one. Workers live on after a task, so what Arrow holds in reserve is
    given back at its end.
    """
    for batch in batches:
        column = batch.column(text)
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        at = 0
        while at < len(column):
            end = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            end = min(max(end, at + 1), len(column))
            texts = column.slice(at, end - at).cast(pa.large_string()).fill_null("")
            yield batch.slice(at, end - at), texts.cast(pa.large_binary())
            at = end
    pa.default_memory_pool().release_unused()


class Words:
    """The words of a block of texts: bytes, borders, document of each, and hashes."""

    def __init__(self, texts: pa.LargeBinaryArray, lower: bool) -> None:
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.raw = raw
        ink = ~_SPACE[raw]
        border = np.zeros(len(raw) + 1, bool)
        border[self.offsets] = True
        first, last = ink.copy(), ink.copy()
        if len(raw):
            first[1:] &= ~ink[:-1] | border[1:-1]
            last[:-1] &= ~ink[1:] | border[1:-1]
        self.ink = ink
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1
        # Index of each document's first word, and one past the last.
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        up, down = _POWERS.upto(len(raw) + 1)
        letters = _LOWER[raw] if lower else raw
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_SYMBOL[letters] * up[:len(raw)], out=sums[1:])
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + lengths * _U(_STEP))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``k`` words inside one document."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * _U(_BASE) + self.hashes[j:j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return at, mix(total[at])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of the distinct shingles of each document, ordered by document.

        A document with fewer than ``k`` words, but one at least, has one shingle of them all.
        """
        at, value = self.windows(k)
        docs = self.doc[at]
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if len(short):
            total = self.counts[short].astype(np.uint64) * _U(_STEP)
            for j in range(k - 1):
                has = self.counts[short] > j
                word = self.hashes[np.minimum(self.bounds[short] + j, len(self.hashes) - 1)]
                total = np.where(has, total * _U(_BASE) + word, total)
            docs = np.concatenate([docs, short])
            value = np.concatenate([value, mix(total)])
        order = np.lexsort((value, docs))
        docs, value = docs[order], value[order]
        keep = np.ones(len(docs), bool)
        keep[1:] = (docs[1:] != docs[:-1]) | (value[1:] != value[:-1])
        return docs[keep], value[keep]


def bounds_of(docs: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` documents begins in an ordered array of document numbers."""
    return np.searchsorted(docs, np.arange(n + 1))
