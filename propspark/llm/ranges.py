"""Range buckets from sampled splitters, as DataFrame expressions.

A sample of the sort keys (at most ``SAMPLE_ROWS`` rows, a documented bound)
is collected and every q-th key becomes a splitter.  Splitters steer only
where rows are sorted, never which rows are compared, so any sample gives
the same result.  At most ``MAX_SPLITTERS`` splitters are used; beyond that
the callers split each range further by a hash.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
MAX_SPLITTERS = 1023
_BLOCK = 32


def sample_rows(df: DataFrame, n_rows: int, seed: int = 7) -> list:
    """About SAMPLE_ROWS rows of ``df`` (all of them if it is smaller)."""
    if n_rows == 0:
        return []
    fraction = min(1.0, SAMPLE_ROWS / n_rows)
    sampled = df if fraction >= 1.0 else df.sample(fraction=fraction, seed=seed)
    return sampled.collect()


def pick_splitters(keys: list[tuple], buckets: int) -> list[tuple]:
    """``buckets - 1`` ascending keys at even distances; None sorts first."""
    order = sorted(keys, key=lambda k: tuple((v is not None, v) for v in k))
    buckets = min(buckets, MAX_SPLITTERS + 1, len(order))
    return [order[len(order) * i // buckets] for i in range(1, buckets)]


def bucket_of(key: Column, splitters: list[tuple], key_type: str) -> Column:
    """Number of splitters at or below ``key`` (a struct column of type
    ``key_type``): the range bucket.  Two short scans, over every
    ``_BLOCK``-th splitter and then within one block, replace one long one."""
    if not splitters:
        return F.lit(0)
    fields = [p.split(":") for p in key_type.removeprefix("struct<").removesuffix(">").split(",")]

    def literal(k: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(k, fields)])

    all_keys = F.array(*[literal(k) for k in splitters])
    if len(splitters) <= _BLOCK:
        return F.size(F.filter(all_keys, lambda s: s <= key))
    heads = F.array(*[literal(k) for k in splitters[_BLOCK - 1::_BLOCK]])
    full = F.size(F.filter(heads, lambda s: s <= key)) * F.lit(_BLOCK)
    rest = F.slice(all_keys, full + 1, _BLOCK)
    return full + F.size(F.filter(rest, lambda s: s <= key))


def buckets_for(total: float, target: float) -> tuple[int, int]:
    """(range buckets, hash parts of each) for ``total`` units of input at
    about ``target`` units each."""
    wanted = max(1, ceil(total / target))
    buckets = min(wanted, MAX_SPLITTERS + 1)
    return buckets, max(1, ceil(wanted / buckets))
