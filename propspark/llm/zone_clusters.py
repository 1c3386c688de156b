"""Centroid clustering (Lloyd's rounds) with zone maps along a Hilbert curve.

Vectors become integers (``floor(scale * x)``), are ordered along a Hilbert
curve and packed into blocks of ``BLOCK`` neighbours.  A block carries the
least and greatest coordinates of its vectors, its box.  In every round the
distances from the box to the centroids bound those of all its vectors, so
that only the block's candidate centroids are compared with them; that
comparison is exact and vectorised.  Bounds that rule out no centroid cost
time only: the result is that of plain Lloyd's rounds.

Boxes and the curve use principal axes, fitted on at most ``AXES_ROWS``
vectors (a bounded sample that steers speed, never results).  Bounds are
widened by more than the rounding of their arithmetic.  Every round reads the
blocks once and sends one row of sums per task and cluster; what the driver
and the workers hold is the ``k`` centroids.

Results for odd input: vectors that are null, have another length than
``dims``, or hold a null or a non-finite component are left out.  Integers
beyond +-2^27 are set to that bound, so that squared distances fit a long.
Repeated rows are vectors of their own; rows of one identifier take part in
the draw of the first centroids one by one (ties by identifier, then vector);
a null identifier is drawn as the empty string and carried through.  With
fewer than ``k`` vectors each is a centroid.  An empty table gives an empty
result.  Sums past a long come out null.  Only the two named columns are
read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propspark.llm.arrow_text import mix
from propspark.llm.tables import written

BLOCK = 64
AXES_ROWS = 4096
#: Coordinates and bits of each that make up the place on the curve.
CURVE_DIMS, CURVE_BITS = 8, 7
LIMIT = 1 << 27
#: Below this size of the integers, double arithmetic on them is exact.
_EXACT = 1 << 21
_SLACK = 1e-9


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n x m integers of
    ``bits`` bits; m * bits <= 63)."""
    x = cells.astype(np.int64).T.copy()
    m = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = np.int64(1) << b, (np.int64(1) << b) - 1
        for i in range(m):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, m):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1, (np.int64(1) << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(m):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column without nulls, ``dims`` values a row (or a multiple)."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _integers(dims: int, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).cast(pa.list_(pa.float64()))
            length = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(length == dims))
            values = vectors.filter(pa.array(length == dims)).flatten()
            x = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # null: NaN
            good = np.isfinite(x).all(axis=1)
            v = np.clip(np.floor(scale * x[good]), -LIMIT, LIMIT).astype(np.int32)
            cuts = pa.array(np.arange(len(v) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)),
                                              pa.ListArray.from_arrays(cuts, pa.array(v.ravel()))], names=["id", "v"])
    return run


class Axes:
    """Principal axes of a sample and the cells of the curve on them."""

    def __init__(self, sample: np.ndarray):
        x = sample.astype(np.float64)
        _, basis = np.linalg.eigh(np.atleast_2d(np.cov(x, rowvar=False)) if len(x) > 1 else np.eye(x.shape[1]))
        self.basis = np.ascontiguousarray(basis[:, ::-1])  # widest first
        lead = self.turn(x)[:, :CURVE_DIMS]
        self.low, self.high = lead.min(axis=0), lead.max(axis=0)

    def turn(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64) @ self.basis

    def key(self, x: np.ndarray) -> np.ndarray:
        lead = self.turn(x)[:, :CURVE_DIMS]
        top = (1 << CURVE_BITS) - 1
        cells = np.clip((lead - self.low) / (self.high - self.low + 1e-9) * top, 0, top)
        return hilbert_key(cells, CURVE_BITS)


def _keys(axes: Axes, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            v = _matrix(batch.column(1), dims)
            # Rows at one place of the curve may be very many: the salt lets range splitters part them.
            salt = mix(np.arange(seen, seen + len(v), dtype=np.uint64)).astype(np.int64)
            seen += len(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(axes.key(v)), pa.array(salt)],
                                             names=["id", "v", "place", "salt"])
    return run


def _packed(axes: Axes, dims: int):
    """Rows in curve order to blocks: ids, vectors end to end, box."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dims)
            if not len(v):
                continue
            first = np.arange(0, len(v), BLOCK)
            cuts = np.append(first, len(v)).astype(np.int32)
            turned = axes.turn(v)
            boxes = [np.minimum.reduceat(turned, first, axis=0), np.maximum.reduceat(turned, first, axis=0)]
            whole = pa.array(np.arange(len(first) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(cuts), batch.column(0)),
                 pa.ListArray.from_arrays(pa.array(cuts * dims), pa.array(v.ravel()))]
                + [pa.ListArray.from_arrays(whole, pa.array(b.ravel())) for b in boxes], names=["ids", "v", "low", "high"])
    return run


class Nearest:
    """Nearest centroids of whole blocks; counts the comparisons made."""

    def __init__(self, centroids: np.ndarray, basis: np.ndarray):
        self.c = centroids.astype(np.int64)
        self.turned = centroids.astype(np.float64) @ basis
        self.norm = (self.turned ** 2).sum(axis=1)
        self.compared = self.possible = 0

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Centroids that may be nearest to a point of the box, ascending."""
        below, above = low - self.turned, self.turned - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
        slack = _SLACK * (1 + self.norm.max() + most.max())
        pivot = int(np.argmin(most))
        left = np.flatnonzero(least <= most[pivot] + slack)
        # Of those, the ones that a point of the box is no farther from than from the pivot.
        step = self.turned[left] - self.turned[pivot]
        reach = np.maximum(low * step, high * step).sum(axis=1)
        return left[self.norm[left] - self.norm[pivot] - 2 * reach <= slack]

    def of_block(self, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each vector; ties: smaller number."""
        near = self.candidates(low, high)
        self.compared += len(near) * len(v)
        self.possible += len(self.c) * len(v)
        c = self.c[near]
        if max(np.abs(v).max(), np.abs(c).max()) <= _EXACT:
            x, y = v.astype(np.float64), c.astype(np.float64)
            d = ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)
        else:
            d = np.stack([((v.astype(np.int64) - row) ** 2).sum(axis=1) for row in c], axis=1)
        best = d.argmin(axis=1)
        return near[best], d[np.arange(len(v)), best]


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    sizes = pa.compute.list_value_length(batch.column("v")).to_numpy() // dims
    cuts = np.append(0, np.cumsum(sizes))
    v, low, high = (_matrix(batch.column(c), dims) for c in ("v", "low", "high"))
    for k in range(len(sizes)):
        yield v[cuts[k]:cuts[k + 1]], low[k], high[k]


def _sums(centroids: np.ndarray, basis: np.ndarray):
    """Per cluster with vectors in the task, one row for each of: count (item
    0), sum of distances (items 1 and 2, halves of 32 bits), sums of
    components."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, basis)
        total = np.zeros((k, 3 + dims), np.int64)
        for batch in batches:
            for v, low, high in _blocks(batch, dims):
                mine, d = nearest.of_block(v, low, high)
                for c in np.unique(mine):
                    at = mine == c
                    total[c, :3] += at.sum(), (d[at] >> 32).sum(), (d[at] & 0xFFFFFFFF).sum()
                    total[c, 3:] += v[at].sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, 3 + dims)), pa.array(np.tile(np.arange(3 + dims), len(used))),
                                          pa.array(total[used].ravel())], names=["cluster", "item", "x"])
    return run


def _round(blocks: DataFrame, centroids: np.ndarray, basis: np.ndarray) -> dict[int, list[int]]:
    """Count, halves of the distance sum and component sums of each cluster
    with vectors: at most k lists of 3 + dims whole numbers."""
    rows = blocks.select("v", "low", "high").mapInArrow(_sums(centroids, basis), "cluster bigint, item bigint, x bigint")
    out: dict[int, list[int]] = {}
    for r in rows.groupBy("cluster", "item").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).collect():
        out.setdefault(r["cluster"], [0] * (3 + centroids.shape[1]))[r["item"]] = int(r["x"])
    return out


def _label(centroids: np.ndarray, basis: np.ndarray):
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, basis)
        for batch in batches:
            made = [nearest.of_block(*b) for b in _blocks(batch, dims)]
            if made:
                yield pa.RecordBatch.from_arrays([batch.column("ids").flatten(),
                                                  pa.array(np.concatenate([m[0] for m in made]).astype(np.int32)),
                                                  pa.array(np.concatenate([m[1] for m in made]))], names=["id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, n: int, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the least hash of ``seed:id``, in that order.
    A threshold on the uniform hash leaves a few times ``k`` identifiers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    hashed = vectors.select(digest.alias("h"), "id", "v")
    share = min(1.0, 4 * k / n)
    while True:
        some = hashed if share >= 1 else hashed.filter(F.col("h") < f"{int(share * 2**32):08x}")
        rows = some.orderBy("h", "id", "v").limit(k).collect()
        if len(rows) == min(k, n):
            return np.array([r["v"] for r in rows], np.int64)
        share = min(1.0, share * 8)


def curve_blocks(vectors: DataFrame, id_type: str, axes: Axes, dims: int) -> DataFrame:
    """``vectors`` (id, v) as a written table of blocks in curve order."""
    placed = vectors.mapInArrow(_keys(axes, dims), f"id {id_type}, v array<int>, place bigint, salt bigint")
    return written(placed.repartitionByRange("place", "salt").sortWithinPartitions("place", "salt").select("id", "v")
                   .mapInArrow(_packed(axes, dims), f"ids array<{id_type}>, v array<int>, low array<double>, high array<double>"),
                   "cluster-blocks")


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, dims: int = 64,
                    rounds: int = 5, scale: float = 256.0, seed: int = 2) -> DataFrame:
    """One row per kept vector: ``id_col``, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256 after ``rounds`` rounds."""
    spark: SparkSession = df.sparkSession
    given = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    id_type = dict(given.dtypes)["id"]
    schema = f"`{id_col}` {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if id_col in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"):
        raise ValueError(f"the identifier is named like an output: {id_col}")
    vectors = written(given.mapInArrow(_integers(dims, scale), f"id {id_type}, v array<int>"), "cluster-vectors")
    n = vectors.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    centroids = first_centroids(vectors, n, k, seed)
    share = int(min(1.0, 2 * AXES_ROWS / n) * (1 << 20))
    sample = vectors.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < share).select("v").limit(AXES_ROWS).collect()
    axes = Axes(np.array([r["v"] for r in sample]) if sample else centroids)
    blocks = curve_blocks(vectors, id_type, axes, dims)
    for _ in range(rounds):
        for c, (n_c, _, _, *sums) in _round(blocks, centroids, axes.basis).items():
            centroids[c] = [x // n_c for x in sums]
    inertia = {c: (high << 32) + low for c, (_, high, low, *_) in _round(blocks, centroids, axes.basis).items()}

    def long(x: int) -> int | None:
        return x if x < 1 << 63 else None

    facts = spark.createDataFrame(
        [(int(c), long(x), long(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, x in inertia.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    labelled = blocks.mapInArrow(_label(centroids, axes.basis), f"id {id_type}, cluster int, distance bigint")
    out = labelled.join(F.broadcast(facts), "cluster")  # k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
