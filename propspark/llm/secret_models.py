"""Secret scans: fixed patterns, and character Markov models of random strings
against ordinary identifiers.

Three patterns (assignments to a secret's name, access keys, long hexadecimal
strings) give the base spans.  Elsewhere every stretch of ``LEAST_CHARS`` or
more characters that a secret may consist of is scored: per character, the
log-likelihood under a model of random strings (one for each alphabet) less
that under the model of ordinary identifiers, both over the two characters
before.  The stretch's best-scoring segment is a further span, of kind
``random``, if its sum reaches ``LEAST_RATIO``, widened to whole words; what is left on
either side is scored again.  Spans of the method never touch base ones.

The models are trained from labelled samples: random strings drawn from each
alphabet, and identifiers that naming conventions make of words of the
corpus (besides decimal numbers and ruling lines).  The words are a bounded sample (``SAMPLE_WORDS`` distinct words with the
least hashes over all documents, so it does not depend on how rows are
split); every text is then scored whole where Spark reads it, without a
shuffle.  The models have a fixed size.

Results for odd input: null and empty texts have no spans; repeated rows and
rows without identifier give a result each; texts of any length are scanned
whole; a corpus without words leaves the smoothing of the ordinary model; an
empty table gives an empty result; a carried column named like an output is
replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.llm.arrow_text import chunks
from propspark.llm.tables import carried, find_package, spare_name

LEAST_CHARS = 20
LEAST_RATIO = 18.0
#: A segment may lose marks at its ends.
SEGMENT_CHARS = 16
SAMPLE_WORDS = 20_000
WORDS_PER_TASK = 20_000
RANDOM_STRINGS = 3_000
#: Weight of the shorter contexts, as in interpolated n-gram models.
BACKOFF = 2.0

# ------------------------------------------------------------ fixed values
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")
# Every assignment holds one of these in some case.
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
ALPHABETS = {
    "hex": b"0123456789abcdef",
    "HEX": b"0123456789ABCDEF",
    "base32": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": b"abcdefghijklmnopqrstuvwxyz0123456789",
    "base62": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
}
# -------------------------------------------------------- end fixed values

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
_LONG_HEX = re.compile(HEX.replace(b"+", b"{%d,}" % HEX_CHARS))
_STRETCH = re.compile(b"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_CHARS)
_WORD = re.compile(r"[A-Za-z]{2,15}")
_SIZE = len(SYMBOLS) + 1
_OTHER = len(SYMBOLS)
_CODE = np.full(256, _OTHER, np.int64)
_CODE[list(SYMBOLS)] = np.arange(len(SYMBOLS))
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")] = True

OUTPUTS = {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "n_random": "bigint", "base_sha256": "string",
           "spans": "string", "secrets": "array<struct<kind:string,start:bigint,end:bigint,value:string>>"}


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the three patterns' matches, by start,
    then kind."""
    out = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data) if len(m.group(2)) >= ASSIGN_CHARS]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_CHARS]
    # The first match at or after a place is a whole run of hexadecimal digits, so long runs are those of the pattern.
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(data)]
    return sorted(out)


def _contexts(codes: np.ndarray) -> np.ndarray:
    """Number of (two symbols before, symbol) at each place of a string."""
    before = np.concatenate([[_OTHER, _OTHER], codes])
    return (before[:-2] * _SIZE + before[1:-1]) * _SIZE + codes


def markov(samples: list[bytes]) -> np.ndarray:
    """Log-probabilities of each symbol after each two, interpolated with
    those after one and after none."""
    joined = np.frombuffer(b"\0\0" + b"\0\0".join(samples) + b"\0\0", np.uint8)  # two marks part the samples
    codes = _CODE[joined]
    three = (codes[:-2] * _SIZE + codes[1:-1]) * _SIZE + codes[2:]
    counts = np.bincount(three[codes[2:] != _OTHER], minlength=_SIZE ** 3).reshape((_SIZE,) * 3).astype(np.float64)
    counts = counts[:, :, :_OTHER]
    one = counts.sum(axis=(0, 1))
    p = (one + 0.5) / (one.sum() + 0.5 * _OTHER)
    for table in (counts.sum(axis=0), counts):
        p = (table + BACKOFF * p) / (table.sum(axis=-1, keepdims=True) + BACKOFF)
    return np.log(np.concatenate([p, np.full((_SIZE, _SIZE, 1), 1e-9)], axis=2)).ravel()


def random_samples(n: int = RANDOM_STRINGS, seed: int = 11) -> dict[str, list[bytes]]:
    """Strings drawn from each alphabet, labelled by its name."""
    rng = np.random.default_rng(seed)
    out = {}
    for name, letters in ALPHABETS.items():
        drawn = np.frombuffer(letters, np.uint8)[rng.integers(len(letters), size=(n, 40))]
        out[name] = [row.tobytes() for row in drawn]
    return out


def ordinary_samples(words: list[str], seed: int = 12) -> list[bytes]:
    """Identifiers that naming conventions make of words, decimal numbers
    and ruling lines (one symbol over and over)."""
    rng = np.random.default_rng(seed)
    lines = [bytes([c]) * 60 for c in SYMBOLS] * 4 + [(row + 48).astype(np.uint8).tobytes() for row in rng.integers(10, size=(RANDOM_STRINGS // 3, 40))]
    if not words:
        return lines
    out = list(words)
    for first in words:
        a, b = (words[i] for i in rng.integers(len(words), size=2))
        parts = [first, a, b]
        lower = [p.lower() for p in parts]
        number = str(rng.integers(10 ** rng.integers(1, 6)))
        made = ("_".join(lower), lower[0] + "".join(p.capitalize() for p in lower[1:]), "".join(p.capitalize() for p in lower),
                "_".join(lower).upper(), "-".join(lower), ".".join(lower), "/".join(lower) + "." + lower[1][:3],
                lower[0] + number, lower[0] + "_" + number, lower[0] + "=" + number, number + "." + number, first.upper())
        out += [made[i] for i in rng.choice(len(made), 5, replace=False)]
    return [w.encode() for w in out] + lines


def _least_words(text_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's distinct words with the least hashes, outside base spans."""
    kept: dict[str, int] = {}
    limit = 1 << 64

    def rank(word: str) -> int:
        return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest())

    seen: set[str] = set()
    for batch in text_batches:
        for text in batch.column(0).fill_null("").to_pylist():
            data = text.encode()
            for start, _, end in reversed(base_spans(data)):
                data = data[:start] + b"\0" + data[end:]
            fresh = set(_WORD.findall(data.decode("utf-8", "replace"))) - seen
            seen |= fresh
            kept |= {w: h for w in fresh if (h := rank(w)) < limit}
        if len(kept) > 2 * WORDS_PER_TASK:
            kept = dict(sorted(kept.items(), key=lambda e: e[1])[:WORDS_PER_TASK])
            limit = max(kept.values())
        if len(seen) > 500_000:
            seen = set(kept)
    rows = sorted(kept.items(), key=lambda e: e[1])[:WORDS_PER_TASK]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()),
                                      pa.array([h - (1 << 63) for _, h in rows], pa.int64())], names=["word", "rank"])


class SecretModel:
    """Log-likelihood ratios per context: one row for each alphabet."""

    def __init__(self, ordinary: list[bytes], random: dict[str, list[bytes]]):
        plain = markov(ordinary)
        self.ratio = np.stack([markov(s) - plain for s in random.values()]).astype(np.float32)

    def score(self, value: bytes) -> float:
        """Sum of the best alphabet over the whole value."""
        return float(self.ratio[:, _contexts(_CODE[np.frombuffer(value, np.uint8)])].sum(axis=1).max()) if value else 0.0

    def segments(self, value: bytes) -> list[tuple[int, int]]:
        """Random segments of a stretch, in order."""
        raw = np.frombuffer(value, np.uint8)
        sums = np.cumsum(self.ratio[:, _contexts(_CODE[raw])].astype(np.float64), axis=1)
        sums = np.concatenate([np.zeros((len(sums), 1)), sums], axis=1)
        alnum = _ALNUM[raw]
        out, todo = [], [(0, len(raw))]
        while todo:
            a, b = todo.pop()
            if b - a < SEGMENT_CHARS:
                continue
            part = sums[:, a:b + 1]
            gain = part - np.minimum.accumulate(part, axis=1)
            k, end = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[k, end] < LEAST_RATIO:
                continue
            start = int(np.argmin(part[k, :end + 1])) + a
            end = int(end) + a
            # Widened to whole words within the stretch left.
            while start > a and alnum[start - 1] and alnum[start]:
                start -= 1
            while end < b and alnum[end] and alnum[end - 1]:
                end += 1
            if end - start >= SEGMENT_CHARS:
                out.append((start, end))
            todo += [(a, start), (end, b)]
        return sorted(out)

    def random_spans(self, data: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(start, kind, end) in bytes of random segments off the base spans."""
        out = []
        taken = sorted((a, b) for a, _, b in base)
        for m in _STRETCH.finditer(data):
            first = m.start()
            for a, b in [t for t in taken if t[1] > m.start() and t[0] < m.end()] + [(m.end(), m.end())]:
                if a - first >= LEAST_CHARS:
                    out += [(first + s, 3, first + e) for s, e in self.segments(data[first:a])]
                first = max(first, b)
        return out


def fit(docs: DataFrame, text_col: str = "text") -> SecretModel:
    """The models of ``docs``: their words against random strings."""
    find_package(docs.sparkSession)
    words = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_least_words, "word string, rank bigint")
             .groupBy("word").agg(F.min("rank").alias("rank")).orderBy("rank", "word").limit(SAMPLE_WORDS).collect())
    return SecretModel(ordinary_samples([r["word"] for r in words]), random_samples())


def _characters(data: bytes) -> np.ndarray:
    """Code points before each byte (and the end)."""
    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.append(0, np.cumsum(lead))


def scan(text: str, model: SecretModel) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points of all spans, by start, then kind."""
    data = text.encode()
    base = base_spans(data)
    found = sorted(base + model.random_spans(data, base))
    if found and len(data) != len(text):
        at = _characters(data)
        found = [(int(at[a]), k, int(at[b])) for a, k, b in found]
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(df: DataFrame, model: SecretModel, text_col: str = "text", carry: list[str] | None = None,
                 outputs: tuple[str, ...] = ("secrets",)) -> DataFrame:
    """``carry`` columns of ``df`` (default: all) and the named ``outputs``."""
    find_package(df.sparkSession)
    carry = carried(df, carry, outputs)
    types = dict(df.dtypes)
    n = len(carry)
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed size
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
    arrow = {o: pa.int64() for o in ("n_assign", "n_access", "n_hex", "n_random")} | {"secrets": pa.list_(item)}

    def made(text: str) -> dict:
        spans = scan(text, shared.value)
        out = {f"n_{name}": sum(s[1] == k for s in spans) for k, name in enumerate(KINDS)}
        out["spans"] = _joined(spans)
        out["base_sha256"] = hashlib.sha256(_joined([s for s in spans if s[1] < 3]).encode()).hexdigest()
        if "secrets" in outputs:
            out["secrets"] = [{"kind": KINDS[k], "start": a, "end": b, "value": text[a:b]} for a, k, b in spans]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n)
            for a, b, _, _ in chunks(texts):
                rows = [made(t) for t in texts.slice(a, b - a).fill_null("").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in range(n)]
                    + [pa.array([r[o] for r in rows], arrow.get(o, pa.string())) for o in outputs], names=[*carry, *outputs])

    given = df.select(*[f"`{c}`" for c in carry], df[f"`{text_col}`"].alias(spare_name(carry, "__text")))
    return given.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in carry] + [f"{o} {OUTPUTS[o]}" for o in outputs]))
