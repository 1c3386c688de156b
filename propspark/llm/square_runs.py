"""Periodic runs of words, found online by catchers of squares.

Words are appended one after another.  Whenever ``s = 2**k`` of them complete
an aligned block, the block becomes a catcher for the periods from ``2s - 1``
to ``4s - 2``: any square of such a period has the whole block in its first
half, so the block must recur one period later.  Every appended word advances,
on each level, the comparison of the ``s``-word suffix that it completes with
the two blocks at such distances.  A suffix equal to a block is a piece of a
repetition of that period; pieces of consecutive blocks merge, and when the
next one fails, the merged piece is extended word by word to its true ends.
It is a run if it is long enough and no shorter period explains it.

On every level an appended word costs two comparisons of window hashes, done
for many words at once in arrays: O(n log n) for n words.  Pieces inside a
run that is known already and of a multiple of its period are left out before
they are extended, so words repeated very often cost no more.

Documents are appended to the same catchers with a word of its own kind
between them, so a batch of short ones costs one pass; a chunk of
``arrow_text.CHUNK_BYTES`` or one longer document is handled at once, wherever
Spark reads it: nothing is shuffled.  Words are compared by 64-bit hashes, and
the whole of every run is compared again word by word.

Results for odd input: null and empty texts have no words and no runs;
repeated rows and rows without identifier give a result each; an empty table
gives an empty result; a carried column named like an output is replaced by
it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from propspark.llm.arrow_text import Words, chunks, mix
from propspark.llm.tables import carried, find_package, spare_name

LEAST_LENGTH = 6
LEAST_POWER = 4
OUTPUTS = {
    "n_words": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
    "exponent_milli": "bigint", "runs": "array<struct<start:bigint,length:bigint,period:bigint>>", "runs_sha256": "string",
    "collapsed": "string", "collapsed_sha256": "string",
}
_NONE = np.zeros((0, 3), np.int64)


class _Level:
    """Catchers of one block size: hashes of windows, open pieces."""

    def __init__(self, size: int):
        self.size = size
        self.base = 0  # position of the first window kept
        self.window = np.zeros(0, np.uint64)
        self.open = _NONE  # pieces (period, first block, last block) that the next block may carry on


def _ragged(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of ``count`` positions from each ``start``."""
    owner = np.repeat(np.arange(len(start)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, start[owner] + within


class SquareCatchers:
    """Runs of appended words.  ``append`` takes any number of words at a
    time; ``finish`` closes what is still open and returns all runs.
    ``longest``: no run is longer (words between documents end every run)."""

    def __init__(self, least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER, longest: int | None = None):
        if least_power < 2:
            raise ValueError("a run is two periods long at least")
        self.least_length, self.least_power = least_length, least_power
        #: Least period of the last level: none where no run can be longer than ``longest``.
        self.most_period = longest // least_power if longest is not None else None
        self.words = np.zeros(0, np.uint64)
        self.n = 0
        self.levels: list[_Level] = []
        self.runs: dict[tuple[int, int], int] = {}  # (start, end): period
        self.long: np.ndarray = _NONE  # runs as (start, end, period), for the levels above

    def _need(self, period: np.ndarray) -> np.ndarray:
        return np.maximum(self.least_length, self.least_power * period)

    def append(self, words: np.ndarray) -> None:
        if self.n + len(words) > len(self.words):
            grown = np.zeros(max(2 * len(self.words), self.n + len(words)), np.uint64)
            grown[:self.n] = self.words[:self.n]
            self.words = grown
        self.words[self.n:self.n + len(words)] = words
        old, self.n = self.n, self.n + len(words)
        while (size := 1 << len(self.levels)) <= max(1, self.n // 2):
            if self.most_period is not None and 2 * size - 1 > self.most_period:
                break
            self.levels.append(_Level(size))
            self._start(self.levels[-1], old)
        below = None
        for level in self.levels:
            self._advance(level, below, old)
            below = level
        for level, above in zip(self.levels, self.levels[1:] + [None]):
            # Blocks up to 6 s back, and what the level above has not read yet.
            keep = self.n - 6 * level.size if above is None else min(self.n - 6 * level.size, above.base + len(above.window))
            if keep - level.base > level.size:
                level.window = level.window[keep - level.base:].copy()
                level.base = keep

    def _start(self, level: _Level, old: int) -> None:
        """Windows of a new level over the words before: the block size is at
        most a quarter of the words, so they are few enough to hash anew."""
        if level.size > 1 and old >= level.size:
            level.window = self._hash(0, old - level.size + 1, level.size)

    def _hash(self, a: int, b: int, size: int) -> np.ndarray:
        out = mix(self.words[a:b + size - 1])
        s = 1
        while s < size:
            out = mix(out[:-s] * np.uint64(0xD6E8FEB86659FD93) + out[s:] + np.uint64(s))
            s *= 2
        return out

    def _advance(self, level: _Level, below: _Level | None, old: int) -> None:
        s = level.size
        done = level.base + len(level.window)  # windows before it are known
        until = max(done, self.n - s + 1)
        if until > done:
            if below is None:
                new = mix(self.words[done:until])
            else:
                h, half = below.window, s // 2
                a, b = h[done - below.base:until - below.base], h[done + half - below.base:until + half - below.base]
                new = mix(a * np.uint64(0xD6E8FEB86659FD93) + b + np.uint64(half))
            level.window = np.concatenate([level.window, new])
        # Suffixes that start at p against the two blocks 2s - 1 to 4s - 2 before p.
        p = np.arange(max(done, level.base), until)
        pieces = [level.open]
        for back in (0, 1):
            block = ((p - 2 * s + 1) // s - back) * s
            ok = block >= level.base
            at, from_ = p[ok], block[ok]
            equal = level.window[at - level.base] == level.window[from_ - level.base]
            at, from_ = at[equal], from_[equal]
            pieces.append(np.stack([at - from_, from_, from_], axis=1))
        merged = self._merge(np.concatenate(pieces), s)
        # The suffix that would carry a piece on is still to come.
        waits = merged[:, 2] + s + merged[:, 0] + s > self.n
        level.open = merged[waits]
        self._close(merged[~waits], s)

    @staticmethod
    def _merge(pieces: np.ndarray, s: int) -> np.ndarray:
        if len(pieces) < 2:
            return pieces
        pieces = pieces[np.lexsort((pieces[:, 1], pieces[:, 0]))]
        new = np.append(True, (pieces[1:, 0] != pieces[:-1, 0]) | (pieces[1:, 1] != pieces[:-1, 2] + s))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pieces)) - 1
        return np.stack([pieces[first, 0], pieces[first, 1], pieces[last, 2]], axis=1)

    def _close(self, pieces: np.ndarray, s: int) -> None:
        """Runs among pieces that no further word carries on."""
        if not len(pieces):
            return
        period, first, last = pieces.T
        # Words equal to the one a period later make up length - period words, which hold this many blocks at least.
        blocks = (last - first) // s + 1
        keep = blocks >= np.maximum(1, (self._need(period) - period - s + 1) // s)
        if len(self.long) and keep.any():
            keep &= ~self._explained(period, first, last, s)
        period, first, last = period[keep], first[keep], last[keep]
        if not len(period):
            return
        start = first - self._reach(first - 1, first - 1 + period, np.minimum(first, s - 1), -1)
        begin = last + s
        end = begin + period + self._reach(begin, begin + period, np.minimum(self.n - begin - period, s - 1), 1)
        found = end - start >= self._need(period)
        for a, b, q in zip(start[found].tolist(), end[found].tolist(), period[found].tolist()):
            if (self.words[a:b - q] == self.words[a + q:b]).all():  # not a mere agreement of window hashes
                self.runs[a, b] = min(q, self.runs.get((a, b), q))
        if found.any():
            self.long = np.array([(a, b, q) for (a, b), q in self.runs.items()], np.int64)

    def _reach(self, left: np.ndarray, right: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``left`` and ``right`` on agree, up to ``most``."""
        most = np.maximum(most, 0)
        owner, within = _ragged(np.zeros(len(left), np.int64), most)
        differ = self.words[left[owner] + step * within] != self.words[right[owner] + step * within]
        out = most.copy()
        np.minimum.at(out, owner[differ], within[differ])
        return out

    def _explained(self, period: np.ndarray, first: np.ndarray, last: np.ndarray, s: int) -> np.ndarray:
        """Pieces inside a run whose period divides theirs.  Of the runs that
        could hold such a piece, those that begin in the same block are
        looked up by it; only the longest of them matters."""
        start, end, q = self.long.T
        fits = end - start >= 2 * s
        if not fits.any():
            return np.zeros(len(period), bool)
        key = -(-start[fits] // s) * s
        order = np.lexsort((end[fits], key))
        key, end, q = key[order], end[fits][order], q[fits][order]
        at = np.searchsorted(key, first, "right") - 1
        same = (at >= 0) & (key[at] == first)
        return same & (end[at] >= last + s + period) & (period % q[at] == 0)

    def finish(self) -> np.ndarray:
        """All runs as rows (start, length, period), by start, then period."""
        for level in self.levels:
            self._close(level.open, level.size)
            level.open = _NONE
        rows = np.array([(a, b - a, q) for (a, b), q in self.runs.items()], np.int64).reshape(-1, 3)
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def chunk_runs(words: Words, least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> list[np.ndarray]:
    """Runs of each document of a chunk, numbered from its first word."""
    n_docs = len(words.count)
    edge = words.first[1:] + np.arange(n_docs)  # place of the word put after each document
    line = np.zeros(len(words.hash) + n_docs, np.uint64)
    between = np.zeros(len(line), bool)
    between[edge] = True
    line[~between] = words.hash
    line[edge] = mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(0xA5A5A5A5 << 24))
    catchers = SquareCatchers(least_length, least_power, int(words.count.max(initial=0)))
    catchers.append(line)
    runs = catchers.finish()
    doc = np.searchsorted(edge, runs[:, 0])
    runs[:, 0] -= (words.first[:-1] + np.arange(n_docs))[doc]
    cuts = np.searchsorted(doc, np.arange(n_docs + 1))
    return [runs[a:b] for a, b in zip(cuts, cuts[1:])]


def _collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words without those after the first period of a run."""
    if not len(runs):
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def find_runs(df: DataFrame, text_col: str = "text", carry: list[str] | None = None,
              outputs: tuple[str, ...] = ("n_words", "n_runs", "runs", "collapsed"),
              least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> DataFrame:
    """``carry`` columns of ``df`` (default: all) and the named ``outputs``
    (``OUTPUTS``): all runs of a text, the longest one (ties: smallest start,
    then period), and the text without the repetitions of its runs."""
    find_package(df.sparkSession)
    carry = carried(df, carry, outputs)
    types = dict(df.dtypes)
    n = len(carry)
    numbers = ("start", "length", "period", "exponent_milli")
    struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def made(words: list[bytes], runs: np.ndarray) -> dict:
        longest = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2])) if len(runs) else None
        best = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
        out = {"n_words": len(words), "n_runs": len(runs), **dict(zip(numbers, best))}
        if "runs" in outputs:
            out["runs"] = [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()]
        if "runs_sha256" in outputs:
            out["runs_sha256"] = _sha("".join(f"{a},{b},{c}\n" for a, b, c in runs.tolist()).encode())
        if "collapsed" in outputs or "collapsed_sha256" in outputs:
            kept = _collapse(words, runs)
            out["collapsed"], out["collapsed_sha256"] = kept.decode() if "collapsed" in outputs else None, _sha(kept)
        return out

    arrow = {**dict.fromkeys(("n_words", "n_runs", *numbers), pa.int64()), "runs": pa.list_(struct)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n)
            for a, b, data, offsets in chunks(texts):
                words = Words(data, offsets)
                found = chunk_runs(words, least_length=least_length, least_power=least_power)
                # bytes.split() cuts at just the characters that part words.
                rows = [made(t.encode().split(), r) for t, r in zip(texts.slice(a, b - a).fill_null("").to_pylist(), found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in range(n)]
                    + [pa.array([r[o] for r in rows], arrow.get(o, pa.string())) for o in outputs], names=[*carry, *outputs])

    given = df.select(*[f"`{c}`" for c in carry], df[f"`{text_col}`"].alias(spare_name(carry, "__text")))
    return given.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in carry] + [f"{o} {OUTPUTS[o]}" for o in outputs]))
