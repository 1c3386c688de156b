"""Join helpers: size-checked broadcast and salted shuffle joins.

``broadcast_if_small`` hints a broadcast only when the optimizer's size
estimate of the side (``stats.sizeInBytes`` of its optimized plan, free to
read: no job runs) is at most ``max_bytes``.  Without cost-based statistics
that estimate is an upper bound for filters, projections and aggregations
(they keep the child's size), so a side that passes is really small.
Beyond the limit the plain join is returned and Spark chooses a shuffle
join; AQE may still turn it into a broadcast from the exact runtime size of
the shuffled side.  Counting the side instead would run its whole upstream
plan twice, a full extra scan when the side is an aggregate of a big table.

``salted_join`` spreads a hot key of the big side over ``buckets`` tasks and
replicates the small side ``buckets`` times; it is used where one key may
hold a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes we accept to ship to every executor (estimated plan size).
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` in bytes (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_bytes) else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a fixed
    vocabulary, a literal table, a month calendar, 25 nations).  Callers
    state the bound where they use it."""
    return F.broadcast(df)


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Fact-to-dimension join; the dimension is broadcast when the check passes."""
    return fact.join(broadcast_if_small(dim, max_bytes), on, how)


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                buckets: int = 8, salt_cols: list[str] | None = None) -> DataFrame:
    """Equi join where each key of ``big`` is spread over ``buckets`` salts.

    ``salt_cols`` (default: all columns of ``big``) feed the hash that picks
    a row's salt, so a row always lands in the same bucket.  ``small`` is
    replicated once per salt.  Only inner and left joins keep the semantics.
    """
    if buckets <= 1:
        return big.join(small, on, how)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    cols = salt_cols or big.columns
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_big.join(salted_small, on + ["_salt"], how).drop("_salt")
