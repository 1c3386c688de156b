"""Outlier trimming, encoding and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.functions.scalar import natural_log, one_hot
from propspark.operators.clean import trim_band
from propspark.operators.ranking import exact_quantiles
from propspark.session import reliable_checkpoint


def quantile_trim(df: DataFrame, col: str, q_lo: float = 0.001, q_hi: float = 0.999,
                  lo: float | None = None, materialize: bool = False) -> tuple[DataFrame, dict]:
    """A16 + P6: keep ``lo <= col <= quantile(q_hi)`` where ``lo`` defaults to
    ``quantile(q_lo)``.  Quantiles are exact (linear interpolation, NULL/NaN
    excluded).  Returns the trimmed frame and both thresholds (Q11).

    The thresholds need one pass over ``df`` and the filter another; with
    ``materialize`` the input is written once as a reliable checkpoint so an
    expensive upstream plan is not computed twice."""
    if materialize:
        df = reliable_checkpoint(df)
    qs = exact_quantiles(df, col, [q_lo, q_hi])
    low = lo if lo is not None else qs[q_lo]
    thresholds = {"q_lo": qs[q_lo], "q_hi": qs[q_hi], "lo": low, "hi": qs[q_hi]}
    if qs[q_hi] is None:
        return df.limit(0), thresholds
    return trim_band(df, col, low, qs[q_hi]), thresholds


def log_onehot(df: DataFrame, value: str, category: str, vocabulary: list[str],
               log_col: str | None = None) -> DataFrame:
    """F13 + F14: ``<value>_log`` and one 0/1 column ``<category>__<v>`` per
    entry of the fixed vocabulary (``distinct_values`` lists one)."""
    cols = {log_col or f"{value}_log": natural_log(value)}
    for v in vocabulary:
        cols[f"{category}__{v}"] = one_hot(category, v)
    return df.withColumns(cols)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-NULL values of a column, sorted, as rows."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def hash_sample(df: DataFrame, n: int, key_cols: list[str], seed: int = 42,
                oversample: float = 1.5) -> DataFrame:
    """L3: exact-size sample without replacement, reproducible whatever the
    partitioning: the n rows with the smallest ``md5(concat_ws('|', key...,
    seed))`` (ties by key).  Fewer than n rows: all rows.

    A plain ``orderBy(h).limit(n)`` sends every partition's top n to one
    final task (n x partitions rows).  md5 is uniform, so instead a
    threshold on the first 60 bits of the hash that should pass about
    ``oversample * n`` rows is chosen from the row count, widened until at
    least n rows pass, and the exact top n is taken from that small
    candidate set.  Every row ordered before the threshold is a candidate,
    so the result is exact.
    """
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    keyed = df.withColumn("_h", h).withColumn("_hv", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long"))
    total = keyed.count()
    if total <= n:
        return keyed.drop("_h", "_hv")
    space = 16 ** 15
    frac = min(1.0, (n * oversample + 64) / total)
    while True:
        cand = keyed.filter(F.col("_hv") < F.lit(int(frac * space))) if frac < 1.0 else keyed
        if frac >= 1.0 or cand.count() >= n:
            break
        frac = min(1.0, frac * 2)
    return cand.orderBy("_h", *key_cols).limit(n).drop("_h", "_hv")
