"""Profiles and counts (A17, A18, A19), one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.operators.ranking import column_quantiles


def class_counts(df: DataFrame, col: str, classes: list[str]) -> DataFrame:
    """Total rows and rows per class, in a single aggregation."""
    aggs = [F.count(F.lit(1)).alias("n_total")]
    aggs += [F.count_if(F.col(col) == c).alias(f"n_{c}") for c in classes]
    return df.agg(*aggs)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, nulls) per column; one aggregation, then unpivot."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def numeric_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, nulls, mean, std, min, 25/50/75 % (exact), max per column.

    Moments come from one aggregation; quartiles of all columns from one
    pass over value histograms (no all-values buffer)."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                 F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = []
    quartiles = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    for c in cols:
        q = quartiles[c]
        rows.append(F.struct(F.lit(c).alias("column_name"),
                             F.col(f"{c}__count").alias("count"), F.col(f"{c}__nulls").alias("null_count"),
                             F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                             F.col(f"{c}__min").cast("double").alias("min"),
                             F.lit(q[0.25]).cast("double").alias("p25"),
                             F.lit(q[0.5]).cast("double").alias("p50"),
                             F.lit(q[0.75]).cast("double").alias("p75"),
                             F.col(f"{c}__max").cast("double").alias("max")))
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
