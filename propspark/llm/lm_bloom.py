"""Language-model scores from a log-frequency Bloom filter.

Words are counted first.  Those that make up more than 1 / ``EXACT_WORDS`` of
the training tokens (fewer than ``EXACT_WORDS`` words, whatever the corpus)
are broadcast with their counts.

Pairs of words, which grow with the corpus, are too many to broadcast.  The
filter is cut into segments by pair hash instead, each of about ``SEG_KEYS``
keys and sized by the keys it holds, and the probes go to the segments:

1. Documents are dealt into chunks of ``CHUNK_ROWS`` (a text of over ``LONG``
   bytes is a chunk of its own).  A chunk sends each segment its distinct
   pairs and its words outside the broadcast ones, each once, with their
   counts in the chunk's training documents.
2. A segment adds the counts up and inserts a pair of count c into the filters
   of all levels up to floor(log2 c).  It probes every pair sent, level after
   level until a probe misses; the last hit is the pair's quantised count.  It
   answers each chunk with one byte a pair, and with exact word counts.
3. A chunk's texts, from the same exchange as in 1, meet its answers.

No level is left out and no key dropped at any size; a segment meets a key
once a chunk at most, so frequent words and pairs load it with chunks, not
with occurrences.

The model: with exact counts c(w) of words, u(w) the smoothed unigram
probability and c(v w) the quantised counts of pairs, P(w | v) =
(min(c(v w), c(v), c(w)) + K u(w)) / (c(v) + K), over the words and the end of
a text, whose first word follows an end.

Results for odd input: a null or empty text is one end token; repeated rows
are scored each on their own (and count each in training); a null identifier
is carried through and counts as the empty string for the folds; an empty
table gives an empty result; with no training rows all counts are 0; columns
other than the identifier and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propspark.llm.arrow_text import Words, chunks, mix
from propspark.llm.tables import find_package, written

EXACT_WORDS = 1 << 16
SEG_KEYS = 1 << 20
KEY_BITS = 12
PROBES = 3
PRIOR = 20.0
CHUNK_ROWS = 1024
LONG = 1 << 16
#: Bytes of text cut into words at once.
PIECE = 1 << 20
#: Words combined in a worker before they are sent on.
COMBINE = 2_000_000
END = np.uint64(0x5BD1E995A7C15F39)
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def fold(id_col: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds))


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): words of each document and then one end."""
    n = len(words.count)
    out = np.full(len(words.hash) + n, END, np.uint64)
    first = words.first + np.arange(n + 1)
    out[np.arange(len(words.hash)) + words.doc()] = words.hash
    return out, first


def pairs(token: np.ndarray) -> np.ndarray:
    """Key of each token with the one before (an end before the first)."""
    before = np.empty_like(token)
    before[1:] = token[:-1]  # a document's first token follows the last one's end
    before[:1] = END
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + token)


class LogFrequencyFilter:
    """Quantised counts of keys: one Bloom filter a level, sized by its keys."""

    def __init__(self, key: np.ndarray, n: np.ndarray, key_bits: int = KEY_BITS):
        key, n = key[n > 0], n[n > 0]
        top = np.frexp(n.astype(np.float64))[1] - 1
        self.levels: list[tuple[np.ndarray, np.uint64]] = []
        for level in range(int(top.max(initial=-1)) + 1):
            own = key[top >= level]
            size = np.uint64(key_bits * len(own) + 64)
            bits = np.zeros(int(size), bool)
            for step in _STEPS[:PROBES]:
                bits[(mix(own + step) % size).astype(np.int64)] = True
            self.levels.append((np.packbits(bits), size))

    def level(self, key: np.ndarray) -> np.ndarray:
        """Last level that holds each key, -1 for none, as bytes."""
        out = np.full(len(key), -1, np.int8)
        live = np.arange(len(key))
        hashes = [mix(key + step) for step in _STEPS[:PROBES]]
        for level, (bits, size) in enumerate(self.levels):
            for h in hashes:
                at = h[live] % size
                hit = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
                live = live[hit.astype(bool)]
            out[live] = level
        return out


def middle(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its counts."""
    return np.where(level < 0, 0.0, np.where(level == 0, 1.0, 1.5 * np.exp2(level.astype(np.float64)) - 0.5))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, n, m): words with their number in training texts and in all."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            key, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            n = np.bincount(at, np.concatenate([w for _, w in held])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(np.bincount(at))],
                                             names=["k", "n", "m"])
            held.clear()

    for batch in batches:
        for a, b, data, offsets in chunks(batch.column(0), PIECE):
            token, first = tokens(Words(data, offsets, lower=True))
            train = ~batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False).astype(bool)
            held.append((token, np.repeat(train, np.diff(first))))
            if sum(len(t) for t, _ in held) > COMBINE:
                yield from flush()
    yield from flush()


def fit(docs: DataFrame, text_col: str = "text", held_col: str = "held_out") -> dict:
    """Totals of the texts not held out, the exact counts of their frequent
    words, and ``asked``: the number of tokens of all texts."""
    find_package(docs.sparkSession)
    words = written(docs.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{held_col}`").alias("h"))
                    .mapInArrow(_word_rows, "k bigint, n bigint, m bigint")
                    .groupBy("k").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "lm-words")
    total = words.agg(*[F.coalesce(c, F.lit(0)).alias(a) for c, a in (
        (F.sum("n"), "n"), (F.count_if(F.col("n") > 0), "v"), (F.sum("m"), "m"))]).first()
    # Fewer than EXACT_WORDS words can be more than that share of the tokens.
    exact = words.filter(F.col("n") * EXACT_WORDS > total["n"]).select("k", "n").collect()
    exact.sort(key=lambda r: r["k"] & (2**64 - 1))
    return {"tokens": total["n"], "types": total["v"], "asked": total["m"],
            "exact_keys": np.array([r["k"] for r in exact], np.int64).view(np.uint64),
            "exact_counts": np.array([r["n"] for r in exact], np.float64)}


class _Chunk:
    """Tokens of a chunk's texts, and its distinct pairs and rare words in
    ascending order (the same however the rows are ordered)."""

    def __init__(self, table: pa.Table, exact: np.ndarray):
        token, count = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for column in table.column("t").chunks:
            for _, _, data, offsets in chunks(column, PIECE):
                own, first = tokens(Words(data, offsets, lower=True))
                token.append(own)
                count.append(np.diff(first))
        self.token, self.count = np.concatenate(token), np.concatenate(count)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.held = table.column("held_out").to_numpy().astype(bool)
        at = np.minimum(np.searchsorted(exact, self.token), max(len(exact) - 1, 0))
        self.exact = exact[at] == self.token if len(exact) else np.zeros(len(self.token), bool)
        self.exact_at = at[self.exact]
        self.words, self.word_at = np.unique(self.token[~self.exact], return_inverse=True)
        self.pairs, self.pair_at = np.unique(pairs(self.token), return_inverse=True)


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``values`` between consecutive ``cuts``, as binary values: the number
    of values, then their first bytes, second bytes and so on, compressed.
    (High bytes of ascending keys and counts repeat.)"""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return pa.array([np.uint32(b - a).tobytes() + pa.compress(flat[a:b].T.tobytes(), codec="zstd", asbytes=True) if b > a else b""
                     for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())


def _joined(column: pa.ChunkedArray, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a column made by ``_cut``, and the cuts."""
    width = np.dtype(dtype).itemsize
    out, sizes = [np.zeros(0, dtype)], [0]
    for piece in column.to_pylist():
        n = int(np.frombuffer(piece, np.uint32, 1)[0]) if piece else 0
        if n:
            flat = np.frombuffer(pa.decompress(piece[4:], n * width, codec="zstd", asbytes=True), np.uint8)
            out.append(np.ascontiguousarray(flat.reshape(width, n).T).view(dtype).ravel())
        sizes.append(n)
    return np.concatenate(out), np.cumsum(sizes)


_ASKS = "seg int, chunk bigint, w binary, wn binary, p binary, pn binary"
_ANSWERS = "chunk bigint, seg int, wn binary, pl binary"


def _asks(exact: np.ndarray, segments: int, table: pa.Table) -> pa.Table:
    """A chunk's rare words and pairs, by segment, with training counts."""
    own = _Chunk(table, exact)
    train = ~own.held[own.doc]
    columns = []
    some = np.zeros(segments, bool)
    for key, at, weight in ((own.words, own.word_at, train[~own.exact]), (own.pairs, own.pair_at, train)):
        n = np.bincount(at, weight, len(key)).astype(np.uint32)
        seg = ((key >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        cuts = np.searchsorted(seg, np.arange(segments + 1, dtype=np.uint64))
        some |= np.diff(cuts) > 0
        columns += [_cut(key, cuts), _cut(n, cuts)]
    number = table.column("chunk")[0].as_py()
    out = pa.Table.from_arrays([pa.array(np.arange(segments, dtype=np.int32)), pa.array(np.full(segments, number, np.int64)), *columns],
                               names=["seg", "chunk", "w", "wn", "p", "pn"])
    return out.filter(pa.array(some))


def _answers(key_bits: int, table: pa.Table) -> pa.Table:
    """A segment's answers to all chunks: exact counts of words, filter
    levels of pairs."""
    word, word_cuts = _joined(table.column("w"), np.uint64)
    _, at = np.unique(word, return_inverse=True)
    counts = np.bincount(at, _joined(table.column("wn"), np.uint32)[0]).astype(np.int64)[at]
    pair, pair_cuts = _joined(table.column("p"), np.uint64)
    key, at = np.unique(pair, return_inverse=True)
    n = np.bincount(at, _joined(table.column("pn"), np.uint32)[0], len(key))
    level = LogFrequencyFilter(key, n, key_bits).level(key)[at]
    return pa.Table.from_arrays([table.column("chunk"), table.column("seg"), _cut(counts, word_cuts), _cut(level, pair_cuts)],
                                names=["chunk", "seg", "wn", "pl"])


_OUT = ("n_tokens bigint", "n_known bigint", "train_tokens bigint", "base_score double", "score double")


def _scores(exact: np.ndarray, counts: np.ndarray, total: int, norm: float, table: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's texts scored with the answers to what it asked."""
    own = _Chunk(table, exact)
    answers = answers.sort_by("seg")
    c = np.empty(len(own.token))
    c[own.exact] = counts[own.exact_at]
    c[~own.exact] = _joined(answers.column("wn"), np.int64)[0][own.word_at]
    both = middle(_joined(answers.column("pl"), np.int8)[0])[own.pair_at]
    end = np.cumsum(own.count) - 1
    context = np.empty(len(c))
    context[1:] = c[:-1]
    # The end before a document's first token is any document's end.
    context[end - own.count + 1] = c[end]
    p = (np.minimum(np.minimum(both, c), context) + PRIOR * (c + 0.5) / norm) / (context + PRIOR)
    n = len(own.count)
    return pa.Table.from_arrays(
        [table.column("doc_id"), table.column("held_out"), pa.array(own.count.astype(np.int64)),
         pa.array(np.bincount(own.doc, c > 0, n).astype(np.int64)), pa.array(np.full(n, total, np.int64)),
         pa.array(np.bincount(own.doc, np.log10((c + 0.5) / norm), n)), pa.array(np.bincount(own.doc, np.log10(p), n))],
        names=["doc_id", "held_out", *[o.split(" ")[0] for o in _OUT]])


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1,
                folds: int = 5) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score.  Rows of fold ``held_out`` are not learnt from."""
    spark = df.sparkSession
    base = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"),
                     (fold(F.col(f"`{id_col}`"), folds) == held_out).alias("held_out"))
    model = fit(base, "t")
    norm = float(model["tokens"] + 0.5 * (model["types"] + 1))
    total = model["tokens"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = max(parts, ceil(model["asked"] / SEG_KEYS))
    shared = spark.sparkContext.broadcast((model["exact_keys"], model["exact_counts"]))
    row = F.monotonically_increasing_id()
    # Both passes read this exchange with all of its columns: Spark runs it once.
    dealt = base.withColumn("row", row).select(
        "doc_id", "t", "held_out", F.when(F.octet_length("t") > LONG, -1 - F.col("row"))
        .otherwise(F.floor(F.col("row") / CHUNK_ROWS)).alias("chunk")).repartition(parts, "chunk")
    asks = dealt.groupBy("chunk").applyInArrow(lambda t: _asks(shared.value[0], segments, t), _ASKS)
    bits = KEY_BITS
    answers = asks.groupBy("seg").applyInArrow(lambda t: _answers(bits, t), _ANSWERS).repartition(parts, "chunk")
    schema = f"doc_id {dict(base.dtypes)['doc_id']}, held_out boolean, {', '.join(_OUT)}"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda t, a: _scores(*shared.value, total, norm, t, a), schema)
