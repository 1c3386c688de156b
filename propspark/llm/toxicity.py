"""Toxicity by noisy-channel deobfuscation.

Tokens that look disguised (digits or symbols among letters, marks between
letters, letters spelled with spaces, a letter three times in a row) become a
lattice: each run of equal characters may stand for the letters it resembles,
for fewer repetitions, or for nothing.  A Viterbi search over all states under
a character trigram model picks the most likely plain word; other tokens are
plain.  Symbols at a token's edge that resemble letters are tried as such too.  The
score of a token is the largest weight of its plain word and the word's
character n-grams, and a text's score is a logistic model over the scores of
its distinct tokens.

Learning: all labelled rows outside the held-out fold are joined to their
texts (up to ``BROADCAST_LABELS`` labels without a shuffle of the texts); word
counts by label are combined over the distinct texts of all folds but one;
weights are log-odds; at most ``MODEL_WORDS`` words, ``MODEL_GRAMS`` n-grams
and ``MODEL_TRIGRAMS`` trigrams, the heaviest, are kept and broadcast.  The
logistic model is fitted on all labelled rows of the fold that the counts leave
out: each of Newton's rounds sums over them on Spark.  The sums are of whole
numbers, so scores do not depend on how rows are split.  Labels, language,
source and identifier are no input of a score.

Results for odd input: null and empty texts have no tokens and get the score
of a text without toxic tokens; repeated rows are scored alike; rows without a
label are scored and not learnt from; several labels of one identifier count
as the highest; a null identifier belongs to the fold of the empty string; no
labels at all give the score 0 to every row; an empty table gives an empty
result; other columns are carried where asked for, and one named like the
score is replaced by it (``drop_toxic`` keeps all columns as they are).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.llm.arrow_text import chunks, tidied
from propspark.llm.lm_bloom import fold
from propspark.llm.tables import carried, find_package, spare_name, written

FOLDS = 5
HELD_OUT = 0
FIT_FOLD = 4
#: More labels are joined to the texts by a shuffle.
BROADCAST_LABELS = 200_000
MODEL_WORDS = 20_000
MODEL_GRAMS = 20_000
MODEL_TRIGRAMS = 60_000
LEAST_COUNT = 3
LEAST_WEIGHT = 1.0
KEPT_TOKENS = 150_000
COMBINE_WORDS = 150_000
#: Rows of features that a task sums.
ROWS_A_TASK = 20_000
#: Longer tokens are cut into pieces of this many characters, all scored;
#: neighbours share ``OVERLAP``, so no shorter word is cut everywhere.
TOKEN_CHARS = 64
OVERLAP = 24
CHUNK = 1 << 20

# ------------------------------------------------------------ fixed values
# Letters that a digit or symbol resembles.
RESEMBLES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
# Marks put between letters.
BETWEEN = ".-_*~,'`^:;/\\=·• "
# Costs (natural logarithm) of a letter replaced, dropped as a mark, repeated
# and written as it stands.
COST_RESEMBLES, COST_BETWEEN, COST_REPEATED, COST_ODD = 0.7, 0.3, 0.5, 9.0
# -------------------------------------------------------- end fixed values

_EDGE = ".,;:!?*&%#\"'()[]{}<>/\\|~`^-_=+$@·•…«»“”„‘’ "
#: Symbols that may be a word's first letters, or its last.
_LEADS, _TAILS = "@$!|€£¡", "@$€£"
_SPELLED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|€£¡])(?:[\s.*_-]{1,2}(?:[^\W_]|[@$!|€£¡])){3,}(?!\S)")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LETTERS = re.compile(r"[^\W\d_]+")


def plain_tokens(text: str) -> set[str]:
    """Distinct lower-case tokens of a text without marks at their edges."""
    out = {t.strip(_EDGE) for t in text.lower().split()}
    out.discard("")
    return out


def edged_tokens(raw: Iterable[str]) -> set[str]:
    """Lower-case tokens with the symbols next to their edges that resemble
    letters: ``$cum`` besides ``cum``.  At the end they must come last."""
    out = set()
    for t in raw:
        if t[0].isalnum() and t[-1] not in _TAILS:
            continue
        core = t.strip(_EDGE)
        if not core or len(core) == len(t):
            continue
        at = t.index(core)
        left, right = t[:at], t[at + len(core):]
        lead, tail = left[len(left.rstrip(_LEADS)):], right[:len(right) - len(right.lstrip(_TAILS))]
        if lead or tail:
            out.add(lead + core + tail)
    return out


class Channel:
    """Restores disguised tokens under a character trigram model."""

    def __init__(self, trigrams: dict[str, float], floor: float):
        self.trigrams, self.floor = trigrams, floor

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """Per run of equal characters: what it may stand for, with its cost."""
        out = []
        for m in re.finditer(r"(.)\1*", token, re.DOTALL):
            c, n = m.group(1), len(m.group())
            if c.isalpha():
                arcs = [(c * min(n, 2), COST_REPEATED * (n > 2))]
                if n > 1:
                    arcs.append((c, COST_REPEATED))
            else:
                arcs = [(x * k, COST_RESEMBLES * k) for x in RESEMBLES.get(c, "") for k in sorted({1, min(n, 2)})]
                if c in BETWEEN:
                    arcs.append(("", COST_BETWEEN))
                if not arcs:
                    arcs.append(("", COST_ODD))
                elif c in RESEMBLES:
                    arcs.append(("", COST_ODD))
            out.append(arcs)
        return out

    def best(self, token: str) -> tuple[float, str]:
        """Cost and letters of the cheapest path: one per state, which is the
        last two letters made."""
        paths = {"^^": (0.0, "")}
        look, floor = self.trigrams.get, self.floor
        for arcs in self.lattice(token) + [[("$", 0.0)]]:
            new: dict[str, tuple[float, str]] = {}
            for state, (cost, made) in paths.items():
                for letters, price in arcs:
                    s, total = state, cost + price
                    for c in letters:
                        total -= look(s + c, floor)
                        s = s[1] + c
                    if s not in new or total < new[s][0]:
                        new[s] = total, made + letters
            paths = new
        cost, made = min(paths.values())
        return cost, made[:-1]  # without the end mark

    def restore(self, token: str) -> str:
        """The most likely plain word."""
        return self.best(token)[1]


def disguised(token: str) -> bool:
    if token.isalpha():
        return _TRIPLE.search(token) is not None
    letters = sum(c.isalpha() for c in token)
    return letters >= 1 and all(c.isalpha() or c in RESEMBLES or c in BETWEEN for c in token)


class TokenScores:
    """Weights of tokens, kept for tokens already seen (bounded)."""

    def __init__(self, words: dict[str, float], grams: dict[str, float], channel: Channel):
        self.words, self.grams, self.channel = words, grams, channel
        self.kept: dict[str, float] = {}

    def of_word(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        marked, get = f"^{word}$", self.grams.get
        for n in (4, 5):
            for i in range(len(marked) - n + 1):
                w = get(marked[i:i + n])
                if w is not None and w > best:
                    best = w
        return best

    def of_token(self, token: str) -> float:
        if (known := self.kept.get(token)) is not None:
            return known
        best = 0.0
        for a in range(0, max(len(token) - OVERLAP, 1), TOKEN_CHARS - OVERLAP):
            part = token[a:a + TOKEN_CHARS]
            found = {part} if part.isalpha() else set(_LETTERS.findall(part))
            if disguised(part):
                found.add(self.channel.restore(part))
            best = max([best, *map(self.of_word, found)])
        if len(self.kept) >= KEPT_TOKENS:
            self.kept = {}
        self.kept[token] = best
        return best

    def features(self, text: str) -> list[float]:
        text = text.lower()
        raw = set(text.split())
        tokens = {t.strip(_EDGE) for t in raw} | edged_tokens(raw)
        tokens.discard("")
        for m in _SPELLED.finditer(text):
            tokens.add(re.sub(r"\s+", "", m.group()))
        scores = sorted((s for t in tokens if (s := self.of_token(t)) > 0), reverse=True)
        top = scores[:3] + [0.0] * 3
        strong = sum(s >= 0.6 * top[0] for s in scores)
        return [top[0], top[1], top[2], float(np.log1p(sum(scores))), float(np.log1p(strong)),
                sum(scores) / (10.0 + len(tokens)), float(np.log1p(len(tokens)))]


N_FEATURES = 7


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic texts, other texts), combined in the worker."""
    counts = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
                                          pa.array([counts[0][w] for w in words], pa.int64())], names=["w", "n1", "n0"])
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for text, y in zip(batch.column(0).fill_null("").to_pylist(), batch.column(1).to_pylist()):
            words = set()
            for t in plain_tokens(text):
                words.update([t] if t.isalpha() else _LETTERS.findall(t))
            counts[y].update(w for w in words if len(w) <= TOKEN_CHARS)
            if len(counts[0]) + len(counts[1]) > COMBINE_WORDS:
                yield flush()
    yield flush()


def _top(counts: DataFrame, key: str, limit: int) -> dict[str, float]:
    """The heaviest log-odds of ``counts`` (key, n1, n0): at most ``limit``."""
    total = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not total["n1"]:
        return {}
    weight = F.log(F.col("n1") / F.lit(total["n1"] + 1.0)) - F.log((F.col("n0") + 2.0) / F.lit((total["n0"] or 0) + 1.0))
    rows = (counts.filter(F.col("n1") >= LEAST_COUNT).withColumn("x", weight).filter(F.col("x") >= LEAST_WEIGHT)
            .orderBy(F.col("x").desc(), key).limit(limit).collect())
    return {r[key]: r["x"] for r in rows}


def fit_words(train: DataFrame) -> TokenScores:
    """``train``: text t, label y (0 or 1).  A text that repeats under one
    label counts once, wherever its rows are; for that the labelled texts
    are shuffled by their hash."""
    train = train.withColumn("__h", F.xxhash64("t")).dropDuplicates(["__h", "y"]).select("t", "y")
    words = written(train.mapInArrow(lambda batches: tidied(_word_rows(batches)), "w string, n1 bigint, n0 bigint")
                    .groupBy("w").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "tox-words")
    marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))

    def cut(n: int):
        last = F.length(marked) - n + 1
        at = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.substring(marked, i, F.lit(n)))

    grams = (words.select(F.explode(F.array_distinct(F.concat(cut(4), cut(5)))).alias("g"), "n1", "n0")
             .groupBy("g").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    padded = F.concat(F.lit("^^"), F.col("w"), F.lit("$"))
    three = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
    trigrams = (words.select(F.explode(three).alias("g"), (F.col("n1") + F.col("n0")).alias("n"))
                .groupBy("g").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "g").limit(MODEL_TRIGRAMS).collect())
    before: Counter = Counter()
    for r in trigrams:
        before[r["g"][:2]] += r["n"]
    model = {r["g"]: float(np.log((r["n"] + 0.1) / (before[r["g"][:2]] + 4.0))) for r in trigrams}
    return TokenScores(_top(words, "w", MODEL_WORDS), _top(grams, "g", MODEL_GRAMS), Channel(model, -9.0))


#: Sums are of whole multiples of 2 ** -_UNIT.
_UNIT = 40
_LOW = (1 << 30) - 1


def _summed(rows: DataFrame, terms: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all ``rows`` (x, y) of ``terms`` (rows x, y: a row of numbers
    for each).  Numbers are cut into two whole ones of few bits, whose sums
    neither round nor overflow, whatever their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = low = 0
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                value = np.ldexp(terms(flat, batch.column(1).to_numpy(zero_copy_only=False).astype(float)), _UNIT - 30)
                whole = np.floor(value)
                high = high + whole.astype(np.int64).sum(axis=0)
                low = low + np.rint(np.ldexp(value - whole, 30)).astype(np.int64).sum(axis=0)
        if not np.isscalar(high):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high))), pa.array(high), pa.array(low)], names=["k", "high", "low"])

    sums = (rows.mapInArrow(run, "k bigint, high bigint, low bigint")
            .groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    return np.array([((r["high"] << 30) + r["low"]) / (1 << _UNIT) for r in sorted(sums)])


def fit_logistic(rows: DataFrame, ridge: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(mean, scale, weights with the constant last) of ``rows`` (x, y) by
    Newton's method; no rows: none."""
    total = _summed(rows, lambda x, y: np.hstack([np.ones((len(x), 1)), x]))
    if not len(total):
        return None
    n = total[0]
    mean = total[1:] / n
    scale = np.sqrt(_summed(rows, lambda x, y: (x - mean) ** 2) / n) + 1e-6
    m = len(mean) + 1
    w, penalty = np.zeros(m), np.full(m, ridge)
    penalty[-1] = 1e-3
    upper = np.triu_indices(m)

    def terms(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Gradient and upper half of the second derivatives, by row."""
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        p = 1 / (1 + np.exp(-np.clip((z * w).sum(axis=1), -30, 30)))
        return np.hstack([z * (p - y)[:, None], z[:, upper[0]] * z[:, upper[1]] * (p * (1 - p) + 1e-9)[:, None]])

    for _ in range(rounds):
        got = _summed(rows, lambda x, y: terms(x, y, w))
        h = np.zeros((m, m))
        h[upper] = got[m:]
        h = h + np.triu(h, 1).T + np.diag(penalty)
        step = np.linalg.solve(h, got[:m] + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


class Model:
    def __init__(self, tokens: TokenScores, logistic):
        self.tokens, self.logistic = tokens, logistic

    def score(self, texts: list[str]) -> np.ndarray:
        if self.logistic is None or not texts:
            return np.zeros(len(texts))
        mean, scale, w = self.logistic
        x = (np.array([self.tokens.features(t) for t in texts]) - mean) / scale
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from the labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    find_package(spark)
    y = (labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("y")).filter("y IS NOT NULL")
         .groupBy("__id").agg(F.max("y").alias("y")))
    if y.count() <= BROADCAST_LABELS:
        y = F.broadcast(y)  # two numbers a row
    base = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("t"))
    base = base.withColumn("f", fold(F.col("__id"), FOLDS)).filter(F.col("f") != HELD_OUT)
    rows = base.join(y, "__id").select("t", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"), "f")
    tokens = fit_words(rows.filter(F.col("f") != FIT_FOLD).select("t", "y"))
    shared = spark.sparkContext.broadcast(tokens)  # bounded by the MODEL_ parameters

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.features(t) for t in batch.column(0).fill_null("").to_pylist()]
            shared.value.kept = {}
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    fit_rows = written(rows.filter(F.col("f") == FIT_FOLD).select("t", "y")
                       .mapInArrow(lambda batches: tidied(features(batches)), "x array<double>, y int"), "tox-features")
    # Few numbers a row: many rows in a task.
    return Model(tokens, fit_logistic(fit_rows.coalesce(1 + fit_rows.count() // ROWS_A_TASK)))


def score_texts(df: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None,
                output: str = "toxicity") -> DataFrame:
    """``carry`` columns (default: all) and ``output`` (0 to 1)."""
    find_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the MODEL_ parameters
    carry = carried(df, carry, [output])
    types = dict(df.dtypes)
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n)
            for a, b, _, _ in chunks(texts, CHUNK):
                score = shared.value.score(texts.slice(a, b - a).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(a, b - a) for k in range(n)] + [pa.array(score)],
                                                 names=[*carry, output])
        shared.value.tokens.kept = {}  # the worker lives on for other work

    given = df.select(*[f"`{c}`" for c in carry], df[f"`{text_col}`"].alias(spare_name(carry, "__text")))
    return given.mapInArrow(lambda batches: tidied(run(batches)), ", ".join([f"`{c}` {types[c]}" for c in carry] + [f"`{output}` double"]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` (its own columns) scored below ``threshold``."""
    columns = docs.columns
    score = spare_name(columns, "toxicity")
    scored = score_texts(docs, fit(docs, labels), output=score)
    return scored.filter(F.col(score) < threshold).select(*[f"`{c}`" for c in columns])
