"""Substring dedup against all windows on small fixtures."""

from __future__ import annotations

import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from propspark.llm import anchors, arrow_text


def brute(rows, window):
    """(n_words, kept text) per (identifier, text)."""
    docs = sorted({(i if i is not None else -2**63, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        gone = set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            if w in seen:
                gone.update(range(k, k + window))
            seen.add(w)
        out[i, t] = len(words), " ".join(w for k, w in enumerate(words) if k not in gone)
    return out


def fixture(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdéf", k=rng.randint(1, 3)))
    passages = [[word() for _ in range(rng.randint(15, 90))] for _ in range(6)]
    rows = []
    for n in range(150):
        body = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            body[len(body) // 2:len(body) // 2] = p[a:] if rng.random() < 0.5 else p
        rows.append((n, rng.choice([" ", "  ", "\n", "\t"]).join(body)))
    rows += [(200 + n, rows[n][1]) for n in range(20)]
    rows += [(300, None), (301, ""), (302, "a " * 60), (303, "x y " * 40), (304, "a " * 19)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_windows(spark, monkeypatch, seed):
    monkeypatch.setattr(anchors, "CHUNK", 4000)  # several chunks per task
    rows = fixture(seed)
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, d string").repartition(5)
    want = brute(rows, 20)
    out = anchors.remove_repeats(df, carry=["doc_id", "d"]).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        n, kept = want[r.doc_id, texts[r.doc_id] or ""]
        assert (r.n_words, r.n_removed, r.kept_text) == (n, n - len(kept.split()), kept)


def test_repeated_rows_and_nulls(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (5, text), (None, text), (7, "q " + text), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((str(r.doc_id), r.n_removed) for r in anchors.remove_repeats(df).collect())
    assert out == [("5", 30), ("5", 30), ("7", 30), ("8", 0), ("None", 0)]
    assert anchors.remove_repeats(df.limit(0)).count() == 0


def test_cover_has_every_difference():
    assert {(a - b) % anchors.PERIOD for a in anchors.COVER for b in anchors.COVER} == set(range(anchors.PERIOD))


def test_many_rows_without_identifier_share_a_passage(spark):
    """Also one identifier with many texts: each text is a document."""
    rng = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(30))
    texts = []
    for k in range(3000):
        own = [f"w{k}x{j}" for j in range(rng.randint(1, 12))]
        if k % 2:
            own.insert(rng.randrange(len(own) + 1), passage)
        texts.append(" ".join(own))
    rows = [(None if k % 3 else 7, t) for k, t in enumerate(texts)] + [(8, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = anchors.remove_repeats(df, carry=["doc_id", "text"]).collect()
    assert len(out) == len(rows)
    # The passage stays in one document and leaves the others; nothing else repeats.
    whole = [r for r in out if passage in r.text]
    assert sorted(r.n_removed for r in whole) == [0] + [30] * (len(whole) - 1)
    assert all(r.n_removed == 0 and r.kept_text == r.text for r in out if passage not in r.text)
    for r in whole:
        if r.n_removed:
            assert r.kept_text.split() == [w for w in r.text.split() if not w.startswith("p")]


def test_texts_are_exchanged_once(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('a b c ', id) AS text")
    plan = anchors.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert "cast(__s" not in plan  # another key type would be another exchange


@pytest.mark.parametrize("lower", [False, True])
def test_words_hashed_in_pieces(monkeypatch, lower):
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\tabCDé") for _ in range(rng.randint(0, 300))) for _ in range(500)] + ["", " ", "y" * 9000, None]
    (_, _, data, offsets), = arrow_text.chunks(pa.array(texts))
    made = []
    for size in (7, 100, 1 << 16, 1 << 30):
        monkeypatch.setattr(arrow_text, "HASH_BYTES", size)
        made.append(arrow_text.Words(data, offsets, lower))
    assert len({w.hash.tobytes() for w in made}) == len({w.first.tobytes() for w in made}) == 1
    words = [w for t in texts for w in (t or "").encode().split()]
    assert len(words) == len(made[0].hash) == made[0].first[-1]


def test_hashing_words_takes_little_memory():
    (_, _, data, offsets), = arrow_text.chunks(pa.array(["some words of a text " * 50] * 1800), 2 << 20)
    tracemalloc.start()
    arrow_text.Words(data, offsets)
    assert tracemalloc.get_traced_memory()[1] < 30e6  # in one piece: about 70 MB
    tracemalloc.stop()
