"""Periodic runs: every definition by brute force, online feeding, odd rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from propspark.llm import square_runs as sr
from propspark.llm.arrow_text import mix


def brute(words, least_length=6, power=4):
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least_length, power * q):
                part = words[i:i + length]
                if not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                    out.append([i, length, q])
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def online(words, steps, power=4, least_length=6):
    values = mix(np.array(words, np.uint64))
    c = sr.SquareCatchers(least_length, power)
    first = 0
    for step in steps:
        c.append(values[first:first + step])
        first += step
    c.append(values[first:])
    return c.finish().tolist()


def periodic(rng, n):
    """Words with planted repetitions, some inside others."""
    out = []
    while len(out) < n:
        kind = rng.randrange(4)
        if kind == 0:
            out += [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        elif kind == 1:
            root = [rng.randrange(2) for _ in range(rng.randrange(1, 12))]
            out += (root * rng.randrange(2, 9))[:rng.randrange(1, 90)]
        elif kind == 2:
            inner = [rng.randrange(2)] * rng.randrange(4, 12) + [2]
            out += inner * rng.randrange(2, 7)
        else:
            out += [7] * rng.randrange(1, 40)
    return out[:n]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.integers(0, 260), st.sampled_from([2, 3, 4, 5]), st.integers(1, 3))
def test_equals_brute_force(seed, n, power, letters):
    rng = random.Random(seed)
    words = periodic(rng, n) if letters == 3 else [rng.randrange(letters + 1) for _ in range(n)]
    least = rng.choice([1, 6, 11])
    want = brute(words, least, power)
    assert online(words, [], power, least) == want
    steps = [rng.choice([1, 1, 2, 5, 17, 64]) for _ in range(n)]
    assert online(words, steps, power, least) == want


def test_word_by_word_over_many_levels():
    rng = random.Random(3)
    words = [rng.randrange(50) for _ in range(40)] + list(range(100, 237)) * 5 + [9] * 300 + [rng.randrange(2) for _ in range(200)]
    want = brute(words)
    assert [40, 685, 137] in want and [r for r in want if r[2] == 1 and r[1] >= 300]
    assert online(words, [1] * len(words)) == want == online(words, [])


def test_one_word_very_often_is_quick():
    n = 200_000
    assert online([5] * n, []) == [[0, n, 1]]
    words = ([1] * 30 + [2]) * 4000
    got = online(words, [])
    assert [0, len(words), 31] in got and len(got) == 4001


def row(words):
    runs = brute(words)
    keep = [True] * len(words)
    for a, n, q in runs:
        keep[a + q:a + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(words), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for w, k in zip(words, keep) if k)))


COLUMNS = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_texts_in_one_chunk(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{x}" for x in periodic(rng, rng.randrange(0, 120))) for _ in range(60)]
    # Equal documents side by side must not make runs across their borders.
    texts += ["same words here"] * 12 + ["x"] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in sr.find_runs(df, carry=["doc_id"], outputs=COLUMNS).collect()}
    assert got == {i: row(t.split()) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    long = "ab cd " * 150_000
    rows = [(None, None, "a"), (None, "", "a"), (1, " \t\n", None), (1, "x x x x x x", "b"), (1, "x x x x x x", "b"),
            (2, "x x x x", "c"), (3, "é é\té\né\x0bé\x0cé\ré", "c"), (4, long, "d"), (5, "w" * 200_000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string")
    got = sr.find_runs(df)
    assert got.columns == ["doc_id", "text", "words", "n_words", "n_runs", "runs", "collapsed"]
    out = got.collect()
    assert len(out) == len(rows)
    by = {(r["text"] or "")[:8]: r for r in out}
    assert (by[""]["n_words"], by[""]["collapsed"]) == (0, "")
    assert by["x x x x "]["collapsed"] == "x" and [tuple(x) for x in by["x x x x "]["runs"]] == [(0, 6, 1)]
    assert by["é é\té\né\x0b"]["n_words"] == 7 and by["é é\té\né\x0b"]["collapsed"] == "é"
    assert by["x x x x"]["n_words"] == 2
    assert by["ab cd ab"]["collapsed"] == "ab cd" and [tuple(x) for x in by["ab cd ab"]["runs"]] == [(0, 300_000, 2)]
    assert sr.find_runs(df.limit(0)).count() == 0
    clash = sr.find_runs(df.withColumnsRenamed({"words": "runs", "doc_id": "__text"}))
    assert clash.columns == ["__text", "text", "n_words", "n_runs", "runs", "collapsed"] and clash.count() == len(rows)
