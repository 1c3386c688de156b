"""BPE encoding and decoding by speculating and verifying.

For each new word a greedy longest match proposes tokens.  A proposal is the
word's BPE result exactly if no merge crosses any of its token borders: at a
border the last symbol of the left token and the first symbol of the right
token are followed back through the merges that made them, and the proposal
fails if at any time the two symbols standing there could have merged before
either of them merged inwards.  The check runs over all adjacent pairs of all
new words at once, on numpy arrays.  Words that fail are merged exactly, in
rank order.  Results by word are kept in a bounded table per worker.

The file is a public tokenizer description (its path is a parameter): NFC and
lower case, words by a fixed pattern, bytes as letters, a word-end mark.

Results for odd input: null and empty texts have no tokens; the strings of
special tokens in a text become their identifiers; other columns are carried
through, and one named like an output is replaced by it; repeated rows are
encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from propspark.llm.tables import carried, find_package, spare_name

#: Words kept per worker, with their tokens.
KEPT_WORDS = 120_000
#: Longer words are not kept.
KEPT_CHARS = 64
_BITS = np.int64(20)
_END = ""
_NEVER = np.int64(1) << np.int64(40)

# ------------------------------------------------------------ fixed values
# Letters and digits that Unicode 16.0, and lower-case forms that 17.0, added to 15.1, which
# the files' word pattern counts with and Python 3.13 does not know.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NEW_DIGITS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
             0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
NEW_LOWER |= {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
NEW_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
# -------------------------------------------------------- end fixed values

OUTPUTS = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string",
           "decoded": "string", "decoded_sha256": "string"}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand
    for themselves, the others for the letters from 256 on in turn."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(extra)) for b in range(256)]


class Vocabulary:
    """Merge tables of a tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.text = {i: t for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text |= {i: t for t, i in self.special.items()}
        self.one = {i: i for i in self.text}  # one object per identifier, however often it is kept
        size = max(self.text) + 1
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        made: list[int] = []
        ends = {ids[b + suffix] for b in byte_letters()}
        keys, ranks = [], []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i, j, k = ids[a], ids[b], ids[(a[:-len(suffix)] if suffix and ids[a] in ends else a) + b]
            self.left[k], self.right[k], self.rank[k] = i, j, rank
            made.append(k)
            if j in ends:
                ends.add(k)
            keys.append((i << int(_BITS)) + j)
            ranks.append(rank)
        order = np.argsort(keys)
        self.keys, self.ranks = np.array(keys, np.int64)[order], np.array(ranks, np.int64)[order]
        letters = byte_letters()
        self.byte = [ids[c] for c in letters]
        self.last = [ids[c + suffix] for c in letters]
        # A token whose own text does not merge back to it is never proposed.
        sound = np.ones(size, bool)
        self.made = np.array(made, np.int64)  # by rank
        sound[self.made] = self.apart(self.left[self.made], self.right[self.made], self.rank[self.made])
        for k in made:
            sound[k] &= sound[self.left[k]] and sound[self.right[k]]
        self.propose = {}
        for t, k in ids.items():
            if sound[k]:
                self.propose[t[:-len(suffix)] + _END if k in ends and suffix else t] = k
        #: Longest proposal by its first four letters, if longer than three.
        self.reach = {}
        for t in self.propose:
            if len(t) > 3:
                self.reach[t[:4]] = max(self.reach.get(t[:4], 3), len(t))
        self.byte_ids, self.last_ids = np.array(self.byte, np.int64), np.array(self.last, np.int64)

    def apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b stay side by side (before merge ``until``)."""
        n = len(a)
        x, y = a.copy(), b.copy()
        gone_x = np.full(n, _NEVER) if until is None else until.copy()
        gone_y = gone_x.copy()
        ok = np.ones(n, bool)
        live = np.arange(n)
        while len(live):
            key = (x[live] << _BITS) + y[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], _NEVER)
            met = (rank < gone_x[live]) & (rank <= gone_y[live])
            ok[live[met]] = False
            born_x, born_y = self.rank[x[live]], self.rank[y[live]]
            live, born_x, born_y = (v[~met & ((born_x >= 0) | (born_y >= 0))] for v in (live, born_x, born_y))
            back = born_x > born_y  # the younger of the two is taken apart
            i, j = live[back], live[~back]
            gone_x[i] = born_x[back]
            x[i] = self.right[x[i]]
            gone_y[j] = born_y[~back]
            y[j] = self.left[y[j]]
        return ok

    def greedy(self, word: str) -> list[int]:
        """Longest matches from the left; ``word`` ends with the end mark."""
        out, i, n, get, reach = [], 0, len(word), self.propose.get, self.reach.get
        while i < n:
            for j in range(min(n, i + reach(word[i:i + 4], 3)), i, -1):
                if j != n - 1 and (k := get(word[i:j])) is not None:
                    out.append(k)
                    i = j
                    break
            else:
                if i != n - 2:
                    raise ValueError(f"no token for {word[i]!r}")
                out.append(self.propose[word[i:]])
                break
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << _BITS) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def exact(self, words: list[bytes]) -> list[list[int]]:
        """Merges in rank order, the leftmost first: in each round every word
        makes the merges of its least rank."""
        size = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.byte_ids[raw]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last_ids[raw[ends]]
        word = np.repeat(np.arange(len(words)), size)
        done_symbol, done_word = [], []
        rank = np.full(len(symbol), _NEVER)  # of each symbol with its right neighbour
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self._ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            length = np.diff(np.append(first, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, first), length)
            final = least == _NEVER
            done_symbol.append(symbol[final])
            done_word.append(word[final])
            symbol, word, rank, least = symbol[~final], word[~final], rank[~final], least[~final]
            if not len(symbol):
                break
            merge = rank == least
            # Of overlapping merges (a a a) every second one counts, from the left.
            run = np.flatnonzero(merge[1:] & merge[:-1]) + 1
            for i in run.tolist():
                if merge[i - 1]:
                    merge[i] = False
            at = np.flatnonzero(merge)
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            at = new[at]
            change = np.unique(np.concatenate([at, at[at > 0] - 1]))
            last = np.append(word[1:] != word[:-1], True)
            rank[change] = _NEVER
            change = change[~last[change]]
            rank[change] = self._ranks(symbol[change], symbol[change + 1])
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        flat, cuts = list(map(self.one.__getitem__, symbol[order].tolist())), np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        return [flat[a:b] for a, b in zip([0, *cuts], cuts)]


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def word_tables(pattern: str) -> tuple[str, str]:
    """The pattern with Unicode 16.0 letters and digits spelled out, and the
    characters on which the regex module's own tables differ from it.  Made
    from all characters there are, so once on the driver."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    plain, odd = pattern, set()
    for kind, new in {"L": NEW_LETTERS, "N": NEW_DIGITS}.items():
        known = {c for c in every if unicodedata.category(c)[0] == kind}
        known |= {chr(c) for a, b in new for c in range(a, b + 1)}
        odd |= known ^ set(regex.findall(rf"\p{{{kind}}}", every))
        codes = sorted(map(ord, known))
        cuts = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
        runs = [(codes[a], codes[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        plain = plain.replace(f"\\p{{{kind}}}", _class(runs))
    odd |= {chr(c) for c in NEW_LOWER}
    return plain, "".join(sorted(odd))


class WordPattern:
    """The file's word pattern with Unicode 16.0 letters and digits.  Texts
    without a character on which the regex module's own tables differ (nearly
    all) use those tables."""

    def __init__(self, pattern: str, tables: tuple[str, str]):
        plain, odd = tables
        self.odd = frozenset(odd)
        self.usual, self.exact = regex.compile(pattern), regex.compile(plain)

    def find(self, text: str) -> list[str]:
        if text.isascii():
            return self.usual.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if self.odd.isdisjoint(text):
            return self.usual.findall(text.lower())
        return self.exact.findall(text.translate(NEW_LOWER).lower())


def _pattern(spec: dict) -> str:
    return next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")


class Encoder:
    """Encodes texts, keeping words already seen (bounded).  ``tables`` of the
    word pattern come from the driver."""

    def __init__(self, spec: dict, tables: tuple[str, str] | None = None):
        self.vocab = Vocabulary(spec)
        pattern = _pattern(spec)
        self.word = WordPattern(pattern, tables or word_tables(pattern))
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")")
        self.letters = dict(enumerate(byte_letters()))
        self.number = {i: str(i) for i in self.vocab.text}
        # Tuples of numbers and strings, which Python's garbage collector does not go through again and again.
        self.kept: dict[str, tuple[tuple[int, ...], str, str]] = {}
        self.again: set[str] = set()  # kept words met since they were learnt
        self.proposed = self.failed = 0

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens stay whole."""
        out = []
        for part in self.special.split(text) if "<|" in text else (text,):
            if part in self.vocab.special:
                out.append(part)
            elif part:
                out += self.word.find(part)
        return out

    def learn(self, words: set[str]) -> dict[str, tuple[tuple[int, ...], str, str]]:
        """Tokens, identifiers as text and decoded text of new words."""
        new = [w for w in words if w not in self.vocab.special]
        greedy = self.vocab.greedy
        proposed = [greedy((w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters))
                           + _END) for w in new]
        length = np.array(list(map(len, proposed)), np.int64)
        flat = np.array(list(chain.from_iterable(proposed)), np.int64)
        bad: set[int] = set()
        if len(flat):
            owner = np.repeat(np.arange(len(new)), length)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, where = np.unique((flat[inner] << _BITS) + flat[inner + 1], return_inverse=True)
            ok = self.vocab.apart(pairs >> _BITS, pairs & ((np.int64(1) << _BITS) - 1))
            bad = set(owner[inner[~ok[where]]].tolist())
        self.proposed += len(new)
        self.failed += len(bad)
        if bad:
            for k, ids in zip(sorted(bad), self.vocab.exact([new[k].encode() for k in sorted(bad)])):
                proposed[k] = ids
        number, text, out = self.number.__getitem__, self.vocab.text.__getitem__, {}
        for w, ids in zip(new, proposed):
            out[w] = tuple(ids), " ".join(map(number, ids)), " ".join(map(text, ids))
        for w in words - set(new):
            i = self.vocab.special[w]
            out[w] = (i,), str(i), w
        return out

    def encode(self, texts: list[str]) -> Iterator[list[tuple[tuple[int, ...], str, str]]]:
        """Per text, the entries of its words."""
        cut = [self.pieces(t) for t in texts]
        if len(self.kept) > KEPT_WORDS:  # words met once make room
            self.kept = {w: self.kept[w] for w in self.again} if len(self.again) <= 0.8 * KEPT_WORDS else {}
            self.again = set()
        words = set().union(*cut)
        fresh = words - self.kept.keys()
        self.again |= words - fresh
        made = self.learn(fresh)
        self.kept |= {w: e for w, e in made.items() if len(w) <= KEPT_CHARS}
        look = self.kept if all(len(w) <= KEPT_CHARS for w in fresh) else self.kept | made
        for part in cut:
            yield [look[w] for w in part]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, shared) -> Encoder:
    """One encoder per worker process; another file replaces it."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(*shared.value)
    return _ENCODERS[path]


def decode(ids: list[int], vocab: Vocabulary) -> str:
    """Token texts joined by a space, special tokens included."""
    return " ".join(vocab.text[i] for i in ids)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_texts(df: DataFrame, path: str, text_col: str = "text", carry: list[str] | None = None,
                 outputs: tuple[str, ...] = ("ids", "n_tokens", "decoded"), chunk_chars: int = 1 << 19) -> DataFrame:
    """``carry`` columns of ``df`` (default: all) and the named ``outputs``:
    ids, n_tokens, ids_sha256, decoded, decoded_sha256."""
    find_package(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shared = df.sparkSession.sparkContext.broadcast((spec, word_tables(_pattern(spec))))  # fixed size: the vocabulary
    carry = carried(df, carry, outputs)
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in carry] + [f"{o} {OUTPUTS[o]}" for o in outputs])
    # Of the identifiers, numbers and strings of a text's words.
    make = {"ids": lambda i, s, t: list(chain.from_iterable(i)), "n_tokens": lambda i, s, t: sum(map(len, i)),
            "ids_sha256": lambda i, s, t: _sha(" ".join(s)), "decoded": lambda i, s, t: " ".join(t),
            "decoded_sha256": lambda i, s, t: _sha(" ".join(t))}
    arrow = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(),
             "decoded": pa.string(), "decoded_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared)
        for batch in batches:
            texts = batch.column(len(carry))
            first = 0
            sizes = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
            while first < len(texts):
                end, chars = first, 0
                while end < len(texts) and (end == first or chars + sizes[end] <= chunk_chars):
                    chars += sizes[end]
                    end += 1
                part = texts.slice(first, end - first).fill_null("").to_pylist()
                made = []
                for entries in encoder.encode(part):
                    own = list(zip(*entries)) or [(), (), ()]
                    made.append([make[o](*own) for o in outputs])
                columns = [batch.column(k).slice(first, end - first) for k in range(len(carry))]
                columns += [pa.array([m[k] for m in made], arrow[o]) for k, o in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, *outputs])
                first = end
        pa.default_memory_pool().release_unused()

    given = df.select(*[f"`{c}`" for c in carry], df[f"`{text_col}`"].alias(spare_name(carry, "__text")))
    return given.mapInArrow(run, schema)
