"""Toxicity: deobfuscation, held-out accuracy, odd rows."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from propspark.llm import toxicity

BAD = ["blockhead", "nitwit", "buffoon", "dimwit", "scoundrel"]


def disguise(word, rng):
    kind = rng.randrange(5)
    if kind == 0:
        return word.replace("o", "0").replace("i", "1").replace("e", "3")
    if kind == 1:
        return ".".join(word)
    if kind == 2:
        return " ".join(word)
    if kind == 3:
        k = rng.randrange(len(word))
        return word[:k] + word[k] * 4 + word[k + 1:]
    return word


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("aeioulnrstdm", k=rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(1500):
        body = rng.choices(words, k=rng.randint(5, 60))
        y = int(rng.random() < 0.2)
        if y:
            for _ in range(rng.randint(1, 3)):
                w = rng.choice(BAD)
                plain = i % 5 != 0 and rng.random() < 0.7
                body.insert(rng.randrange(len(body)), w if plain else disguise(w, rng))
        rows.append((i, " ".join(body)))
        labels.append((i, y))
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, toxicity double").drop("toxicity")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy_with_disguised_words(spark, corpus):
    docs, labels, y = corpus
    model = toxicity.fit(docs, labels)
    assert model.tokens.channel.restore("n1tw1t") == "nitwit"
    assert model.tokens.channel.restore("buffffoooon") == "buffoon"
    assert model.tokens.channel.restore("b.l.o.c.k.h.e.a.d") == "blockhead"
    out = toxicity.score_texts(docs, model).filter(toxicity.fold(F.col("doc_id")) == 0).collect()
    score, label = np.array([r["toxicity"] for r in out]), np.array([y[r["doc_id"]] for r in out])
    assert ((score >= 0.5) == label).mean() > 0.95
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_odd_rows(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    rows = [(None, "nitwit"), (1, None), (2, ""), (3, "x" * 300_000), (3, "x" * 300_000), (4, "... !!! 11"), (5, "NITWIT n1tw1t")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.score_texts(df, model).collect()
    assert len(out) == len(rows) and all(0 <= r["toxicity"] <= 1 for r in out)
    by = {r["text"]: r["toxicity"] for r in out}
    assert by[None] == by[""] < 0.5 <= by["NITWIT n1tw1t"]
    assert toxicity.score_texts(df.limit(0), model).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r["toxicity"] for r in toxicity.score_texts(df, nothing).collect()} == {0.0}


def _all_paths(channel, token):
    """(cost, letters) of every path through the token's lattice."""
    out = []
    for arcs in itertools.product(*channel.lattice(token)):
        made = "".join(letters for letters, _ in arcs)
        marked = "^^" + made + "$"
        cost = sum(price for _, price in arcs)
        out.append((cost - sum(channel.trigrams.get(marked[i:i + 3], channel.floor) for i in range(len(marked) - 2)), made))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_restored_words_are_the_best_of_all_paths(seed):
    rng = random.Random(seed)
    letters = "oilzeasgtbc"
    model = {a + b + c: -rng.random() * 8 for a in "^" + letters for b in "^" + letters for c in letters + "$" if rng.random() < 0.8}
    channel = toxicity.Channel(model, -9.0)
    for _ in range(60):
        token = "".join(rng.choice("oiseatlb013457$!@.|-*#") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 6)))
        paths = _all_paths(channel, token)
        cost, word = channel.best(token)
        least = min(c for c, _ in paths)
        assert cost == pytest.approx(least, abs=1e-9)
        assert min(c for c, w in paths if w == word) == pytest.approx(least, abs=1e-9)
        assert channel.restore(token) == word


def test_disguises_at_edges_across_cuts_and_spelled_symbols(spark, corpus):
    docs, labels, _ = corpus
    tokens = toxicity.fit(docs, labels).tokens
    assert toxicity.edged_tokens('"$coundrel," (n1twit) plain 50$ !!'.split()) == {"$coundrel", "50$"}
    assert tokens.channel.restore("$coundrel") == "scoundrel"
    assert tokens.of_token("$coundrel") == tokens.of_word("scoundrel") > 0
    for shift in range(48):  # wherever the cuts fall
        assert tokens.of_token("7" * (30 + shift) + "nitwit" + "7" * 60) >= tokens.of_word("nitwit")
    top = tokens.of_word("scoundrel")
    assert tokens.features("xx $ c o u n d r e l yy")[0] == top


def _fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture()
def small_bounds(monkeypatch):
    """Bounds that the corpus exceeds, those of earlier samples too."""
    for name, value in (("LABEL_ROWS", 100), ("FIT_ROWS", 10), ("BROADCAST_LABELS", 100), ("ROWS_A_TASK", 50)):
        monkeypatch.setattr(toxicity, name, value, raising=False)


def test_words_and_weights_come_from_all_labelled_rows(spark, corpus, small_bounds):
    docs, labels, y = corpus
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    counts = (Counter(), Counter())
    for label in (0, 1):
        for t in {t for i, t in texts.items() if y[i] == label and _fold(i) not in (toxicity.HELD_OUT, toxicity.FIT_FOLD)}:
            found = set()
            for w in toxicity.plain_tokens(t):
                found.update([w] if w.isalpha() else toxicity._LETTERS.findall(w))
            counts[label].update(found)
    n0, n1 = (c.total() + 1.0 for c in counts)
    want = {w: np.log(c / n1) - np.log((counts[0][w] + 2.0) / n0) for w, c in counts[1].items() if c >= toxicity.LEAST_COUNT}
    want = {w: x for w, x in want.items() if x >= toxicity.LEAST_WEIGHT}
    assert model.tokens.words == pytest.approx(want) and len(want) >= len(BAD)

    rows = [i for i in texts if _fold(i) == toxicity.FIT_FOLD]
    x = np.array([model.tokens.features(texts[i]) for i in rows])
    label = np.array([y[i] for i in rows], float)
    mean, scale, w = model.logistic
    assert mean == pytest.approx(x.mean(axis=0)) and scale == pytest.approx(x.std(axis=0) + 1e-6)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    slope = z.T @ (1 / (1 + np.exp(-z @ w)) - label) + np.array([1.0] * 7 + [1e-3]) * w
    assert np.abs(slope).max() < 1e-6  # the minimum over all rows of the fold


def test_scores_do_not_depend_on_the_join_or_on_how_rows_are_split(spark, corpus, monkeypatch):
    docs, labels, _ = corpus

    def scores(n):
        out = toxicity.score_texts(docs, toxicity.fit(docs.repartition(n), labels.repartition(n))).collect()
        return {r["doc_id"]: r["toxicity"] for r in out}

    few = scores(1)
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 100)
    monkeypatch.setattr(toxicity, "ROWS_A_TASK", 20)
    assert scores(11) == few
