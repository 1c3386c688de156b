"""Deterministic dedup without per-key windows.

All three operators are aggregations (``groupBy`` + ``min``/``max`` of a
struct of all other columns; sort based where the struct holds strings).
Spark combines them map-side, so a key holding a third of all
rows is reduced in every task before the shuffle instead of being sorted in
one task as a ``row_number()`` window would.

* ``dedup_subset`` (A22/W1): one row per key, the survivor is the row whose
  remaining columns are smallest (NULLs first), i.e. the same row as
  ``row_number() OVER (PARTITION BY key ORDER BY rest NULLS FIRST) = 1``.
* ``distinct_dim`` (A23): NULL keys removed, then one row per key.
* ``last_wins`` (W4): per key the row with the largest sequence value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _survivor(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order if c not in keys]
    tail = [c for c in rest if c not in order]
    # Sort-key fields first, then every other column as a tie-break.
    names = {c: f"_f{i}" for i, c in enumerate([*order, *tail])}
    packed = F.struct(*[F.col(c).alias(n) for c, n in names.items()])
    agg = df.groupBy(*keys).agg(pick(packed).alias("_s"))
    return agg.select(*keys, *[F.col(f"_s.{n}").alias(c) for c, n in names.items()]).select(*df.columns)


def dedup_subset(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per ``keys``; survivor = smallest ``order`` then remaining columns."""
    return _survivor(df, keys, order or [], F.min)


def distinct_dim(df: DataFrame, key: str, cols: list[str], order: list[str] | None = None) -> DataFrame:
    """Dimension rows: ``cols`` projected, NULL ``key`` removed, one row per key."""
    proj = df.select(key, *[c for c in cols if c != key]).filter(F.col(key).isNotNull())
    return dedup_subset(proj, [key], order)


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Per key the row with the largest ``seq`` (INSERT OR REPLACE order)."""
    return _survivor(df, keys, [seq], F.max)
