"""Decontamination against all pairs on a small fixture."""

from __future__ import annotations

import random
import re

from propspark.llm import spaced_seeds as S


def cut(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def best_overlap(doc, item):
    """Best-scoring run over all alignments."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        run = 0
        for q, word in enumerate(item):
            if 0 <= shift + q < len(doc):
                run = max(0, run + (1 if doc[shift + q] == word else -S.MISMATCH))
                best = max(best, run)
    return best


def fixture():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, text(rng.randint(15, 60))) for k in range(12)] + [(90, text(4)), (91, [])]
    docs = []
    for n in range(60):
        body = text(rng.randint(0, 120))
        if n % 3 == 0:
            passage = list(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 1, 2])):
                passage[rng.randrange(len(passage))] = "swapped"
            body = body[:20] + passage + body[20:]
        if n % 10 == 1:
            body = body + items[12][1]
        docs.append((n, ", ".join(body).title() + "."))
    return docs + [(100, None), (101, "")], [(k, " ".join(w)) for k, w in items] + [(92, None)]


def test_pairs_equal_all_alignments(spark):
    docs, items = fixture()
    ddf = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, item_id long").repartition(3)
    idf = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in docs:
        for k, x in items:
            w = cut(x)
            if w and (score := best_overlap(cut(t), w)) >= min(S.MIN_SCORE, len(w)):
                want[i, k] = score
    for limit in (S.BROADCAST_BYTES, 0):  # both kinds of join
        S.BROADCAST_BYTES, kept = limit, S.BROADCAST_BYTES
        got = {(r["doc_id"], r["item_id"]): r["score"] for r in S.find_overlaps(ddf, idf).collect()}
        S.BROADCAST_BYTES = kept
        # Around a hit REACH words are compared, so longer overlaps score less.
        assert got.keys() == want.keys()
        assert all(got[k] <= want[k] for k in got)
    left = {r["doc_id"] for r in S.drop_contaminated(ddf, idf).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in want}


def test_empty_tables_and_odd_rows(spark):
    idf = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")],
                                "item_id long, text string")
    text = "Zero ONE two-three four five six; seven eight nine ten eleven twelve thirteen!"
    ddf = spark.createDataFrame([(None, text), (3, text), (3, text), (4, "x " * 20000)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["matched"], r["words"]) for r in S.find_overlaps(ddf, idf).collect())
    assert got == [("3", 13, 13), ("None", 13, 13)]
    assert S.find_overlaps(ddf.limit(0), idf).count() == 0
    assert S.find_overlaps(ddf, idf.limit(0)).count() == 0
    assert S.drop_contaminated(ddf, idf).count() == 1


def test_one_swap_at_each_place_and_every_fifth_word(spark):
    items = [(n, [f"w{n}x{k}" for k in range(n)]) for n in [*range(9, 21), 59]]
    docs = []
    for n, item in items[:-1]:
        for k in range(n):
            docs.append((n, ["before"] * 5 + item[:k] + ["swapped"] + item[k + 1:] + ["after"] * 5))
        docs.append((n, item[1:]))
        docs.append((n, ["swapped", *item[1:]]))
    docs += [(59, [w if k % 5 != r else "swapped" for k, w in enumerate(items[-1][1])]) for r in range(5)]
    far = [(n, [*item[:2], "swapped", *item[3:5], "swapped", *item[6:]]) for n, item in items[:6]]  # two of few words
    ddf = spark.createDataFrame([(k, " ".join(w)) for k, (_, w) in enumerate(docs + far)], "doc_id long, text string")
    idf = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in S.find_overlaps(ddf, idf).collect()}
    assert got == {(k, n) for k, (n, _) in enumerate(docs)}
