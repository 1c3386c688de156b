"""Centroid clustering: the curve, the bounds, plain rounds, odd rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from propspark.llm import zone_clusters as zc

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def plain(rows, k, dims, rounds=5, seed=2):
    """Lloyd's rounds without blocks: (id, cluster, distance) of kept rows."""
    kept = []
    for i, v, *_ in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-zc.LIMIT, min(zc.LIMIT, math.floor(256 * float(np.float32(x))))) for x in v]))
    order = sorted(kept, key=lambda e: (hashlib.sha256(f"{seed}:{'' if e[0] is None else e[0]}".encode()).hexdigest(), e[0] or 0, e[1]))
    centroids = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        mine = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            some = [v for (_, v), m in zip(kept, mine) if m == j]
            if some:
                centroids[j] = [sum(x) // len(some) for x in zip(*some)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centroids


def check(spark, rows, k, dims, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = zc.cluster_vectors(df, k=k, dims=dims, **kw).collect()
    want, centroids = plain(rows, k, dims)
    key = lambda e: (e[0] is None, e[0] or 0, e[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.inertia == sum(d for *_, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    return got


def test_the_curve_visits_neighbours():
    for m, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * m, indexing="ij"), axis=-1).reshape(-1, m)
        key = zc.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 6), st.sampled_from([3, 200, 1 << 22, zc.LIMIT]))
def test_no_nearest_centroid_is_ruled_out(seed, k, dims, size):
    rng = np.random.default_rng(seed)
    c = rng.integers(-size, size + 1, (k, dims))
    v = c[rng.integers(k)] + rng.integers(-max(1, size // 9), max(2, size // 9), (20, dims))
    v = np.clip(v, -zc.LIMIT, zc.LIMIT).astype(np.int32)
    axes = zc.Axes(v)
    turned = axes.turn(v)
    mine, d = zc.Nearest(c, axes.basis).of_block(v, turned.min(axis=0), turned.max(axis=0))
    want = ((v[:, None].astype(np.int64) - c) ** 2).sum(axis=2)
    assert (mine == want.argmin(axis=1)).all() and (d == want.min(axis=1)).all()


def test_boxes_rule_out_far_centroids(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (12, 16))
    v = np.floor(256 * (centres[rng.integers(12, size=6000)] + rng.normal(0, 0.05, (6000, 16)))).astype(np.int32)
    axes = zc.Axes(v)
    v = v[np.argsort(axes.key(v))]
    nearest = zc.Nearest(np.floor(256 * centres).astype(np.int64), axes.basis)
    for a in range(0, len(v), zc.BLOCK):
        box = axes.turn(v[a:a + zc.BLOCK])
        nearest.of_block(v[a:a + zc.BLOCK], box.min(axis=0), box.max(axis=0))
    assert nearest.compared < 0.25 * nearest.possible


def test_equals_plain_rounds_with_a_hot_vector(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 6).astype(np.float32).tolist(), "x") for i in range(400)]
    hot = rows[7][1]
    rows += [(1000 + i, hot, "copy") for i in range(200)]
    check(spark, rows, 9, 6)
    # The same rows in another order and number of partitions.
    a = check(spark, rows[::-1], 9, 6)
    assert len(a) == 600


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25], "a"), (1, [0.5, -0.25], "a"), (1, [3.0, 1.0], None), (None, [1.0, 1.0], "b"), (None, [1.0, 1.5], "b"),
            (2, None, "c"), (3, [], "c"), (4, [1.0], "c"), (5, [1.0, None], "c"), (6, [nan, 0.0], "c"), (7, [0.0, inf], "c"),
            (8, [1.0, 2.0, 3.0], "c"), (9, [3e38, -3e38], "d"), (10, [-0.001, 0.0], "e")]
    got = check(spark, rows, 3, 2)
    assert len(got) == 7
    check(spark, rows, 40, 2)  # fewer vectors than centroids
    empty = zc.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0
    assert zc.cluster_vectors(spark.createDataFrame(rows[5:7], SCHEMA), dims=2).count() == 0
    with pytest.raises(ValueError):
        zc.cluster_vectors(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("vec_id", "inertia").select("inertia", "embedding"), "inertia")
