"""Near duplicates against all pairs on a small fixture."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np

from propspark.llm import bagminhash
from propspark.llm.components import components


def brute_classes(rows):
    """class id by identifier, from all pairs."""
    bags = {i: Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").split()) else None
            for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = bags[a], bags[b]
            if x and y:
                common = sum((x & y).values())
                if common / (sum(x.values()) + sum(y.values()) - common) >= 0.8:
                    ra, rb = sorted((root(a), root(b)))
                    parent[rb] = ra
    return {i: root(i) for i in ids}


def fixture_rows(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    rows, n = [], 0
    passage = [word() for _ in range(60)]
    for _ in range(40):
        base = [word() for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    hot = [word() for _ in range(150)]
    for _ in range(80):
        copy = list(hot)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((n, " ".join(copy)))
        n += 1
    for _ in range(60):
        rows.append((n, " ".join(passage + [word() for _ in range(rng.randint(5, 60))])))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "one two"), (n + 4, "ha " * 50), (n + 5, "ha " * 47)]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = fixture_rows()
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, node long, `class` string")
    out = bagminhash.near_duplicates(df).collect()
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in out} == want
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in out)
    assert {r["doc_id"] for r in out if r["kept"]} == set(want.values())
    kept = bagminhash.drop_near(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (None, None)], "doc_id long, text string")
    out = sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"]) for r in bagminhash.near_duplicates(df).collect())
    assert out == [("5", "5", 3), ("5", "5", 3), ("None", "5", 3), ("None", "None", 1)]
    assert sum(r["kept"] for r in bagminhash.near_duplicates(df).collect()) == 2
    assert sorted(map(tuple, bagminhash.drop_near(df).collect()), key=str) == [(5, text), (None, None)]
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0


def test_many_rows_without_identifier(spark):
    """They are told apart by their texts, in time that grows with their number."""
    rng = random.Random(4)
    rows = []
    for k in range(1000):
        words = [f"w{rng.randrange(4000)}" for _ in range(30)]
        rows += [(None, " ".join(words)), (None, " ".join(words[:-1] + ["z"])), (k if k % 2 else None, " ".join(words[2:] + [f"u{k}"]))]
    long = " ".join(f"w{rng.randrange(4000)}" for _ in range(60_000))
    rows += [(None, long), (None, long + " end"), (-5, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = bagminhash.near_duplicates(df).collect()
    assert len(out) == len(rows) and sum(r["kept"] for r in out) == 1002
    kept = bagminhash.drop_near(df).collect()
    assert len(kept) == 1002
    # Of a class the row with an identifier stays, where there is one.
    assert {r["doc_id"] for r in kept} == {None, -5, *range(1, 1000, 2)}


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(1)
    key = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = rng.integers(1, 40, 300)
    b = np.where(rng.random(300) < 0.3, rng.integers(1, 40, 300), a)
    doc = np.repeat([0, 1], 300)
    sig = bagminhash.signatures(doc, np.tile(key, 2), np.concatenate([a, b]), 2, 6000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.02


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(1, k) for k in range(1000, 1100)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {i: 100 for i in range(101, 401)} | {k: 1 for k in range(1000, 1100)}


def test_points_of_many_short_documents_take_little_memory():
    n = 1000
    doc, key = np.repeat(np.arange(n), 3), np.arange(3 * n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    count = np.ones(3 * n, np.int64)
    tracemalloc.start()
    sig = bagminhash.signatures(doc, key, count, n, 280)
    assert tracemalloc.get_traced_memory()[1] < 50e6  # one block for all: about 200 MB
    tracemalloc.stop()
    assert (bagminhash.signatures(doc[-3:] - (n - 1), key[-3:], count[-3:], 1, 280) == sig[-1]).all()
