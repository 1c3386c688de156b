"""Text columns of Arrow batches as bytes, in bounded chunks, and word hashes.

A word is ``[^\\x20\\x09-\\x0D]+``.  All work is on numpy arrays over the
UTF-8 bytes of a chunk of documents: no Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

_TABLE = np.random.default_rng(20240601).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, xor, multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of a string
    column; null is empty.  Offsets start at 0."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def gathered(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined until their column number ``text`` holds
    ``limit`` bytes, for work that combines within what it sees at once."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= limit:
            full = pa.concat_batches(held) if len(held) > 1 else held[0]
            held, size = [], 0  # not held twice while the joined one is worked on
            del batch
            yield full
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` of a task, at whose end freed memory goes back to the
    system, as the worker lives on."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
    if trim is not None:
        trim(0)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


#: Bytes whose words are hashed at once: some ten arrays of 8 bytes a byte.
HASH_BYTES = 1 << 16


def _hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the words that begin at ``starts``."""
    at = np.flatnonzero(inside)
    begin = np.flatnonzero(starts[at])  # of each word within the kept bytes
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = np.diff(np.append(begin, len(at)))
    within = np.arange(len(at)) - np.repeat(begin, length)
    value = _TABLE[data[at]]
    value *= _powers(int(length.max()))[within]
    return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))


class Words:
    """Words of a chunk: ``hash`` (uint64) of each, and ``first`` (index of
    the first word of each document, one more at the end).  Hashed in pieces
    that end where words begin, so that little memory is needed."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        space = (data == 32) | ((data >= 9) & (data <= 13))
        inside = ~space
        starts = inside.copy()
        starts[1:] &= space[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        starts[edge] = inside[edge]
        self.start = np.flatnonzero(starts)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.hash = np.empty(len(self.start), np.uint64)
        cut = np.searchsorted(self.start, np.arange(HASH_BYTES, len(data), HASH_BYTES))
        cuts = np.unique(np.concatenate([[0], cut, [len(self.start)]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            lo, hi = self.start[a], self.start[b] if b < len(self.start) else len(data)
            self.hash[a:b] = _hashes(data[lo:hi], inside[lo:hi], starts[lo:hi])
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Index of each word's document."""
        return np.repeat(np.arange(len(self.count)), self.count)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_hash(words: np.ndarray, at: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``width`` word hashes from each position in ``at``."""
    out = np.full(len(at), np.uint64(seed), np.uint64)
    for k in range(width):
        out *= _STEP
        out += words[at + k]
    return mix(out)


def window_starts(words: Words, width: int) -> np.ndarray:
    """Positions at which ``width`` words of one document begin."""
    n = np.maximum(words.count - width + 1, 0)
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(n) - n
    return np.arange(total) - np.repeat(before, n) + np.repeat(words.first[:-1], n)


def strings(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()
