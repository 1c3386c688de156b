"""Missing-value handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propspark.constants import COMMUNE_POPULATION, POI_CATEGORIES, POI_RADIUS_M
from propspark.functions.scalar import (department_prefix, fill_missing,
                                        households_from_population, missing_flag)
from propspark.operators.joins import bounded_broadcast


def distance_missing_flags(df: DataFrame, categories=POI_CATEGORIES, radii=POI_RADIUS_M,
                           prefix: str = "distance_min_") -> DataFrame:
    """``<col>_manquante`` = 1 when the distance is NULL or NaN (Q1), and
    the distance is filled with the category radius."""
    cols = {}
    for c in categories:
        d = f"{prefix}{c}"
        cols[f"{d}_manquante"] = missing_flag(d)
        cols[d] = fill_missing(d, float(radii[c]))
    return df.withColumns(cols)


def group_mean_impute(df: DataFrame, value: str, code: str,
                      group_expr=department_prefix) -> DataFrame:
    """A1 + J5 + F11: fill NULL ``value`` with the mean of its group, the
    group being ``group_expr(code)`` (department prefix, F9).

    The mean is a hash aggregate (partial aggregation map-side, so a hot
    department is reduced per task) joined back on the group key; the
    per-group table has one row per prefix (about 100) and is broadcast, so
    the rows are not shuffled on so few keys.  The mean is weighted by
    rows, as in the source pipeline.  A NULL group never matches.
    """
    g = "_grp"
    keyed = df.withColumn(g, group_expr(code))
    means = keyed.groupBy(g).agg(F.avg(value).alias("_grp_mean")).filter(F.col(g).isNotNull())
    out = keyed.join(bounded_broadcast(means), g, "left")
    return out.withColumn(value, F.coalesce(F.col(value), F.col("_grp_mean"))).drop(g, "_grp_mean")


def households_dim(spark: SparkSession, rows=COMMUNE_POPULATION) -> DataFrame:
    """S11 + F12: the literal commune population table with estimated households."""
    dim = spark.createDataFrame(list(rows), "code_commune string, population long")
    return dim.select("code_commune", households_from_population("population").alias("nb_menages_estime"))


def literal_household_fill(df: DataFrame, dim: DataFrame, target: str = "nb_menages_2021_commune",
                           key: str = "code_commune") -> DataFrame:
    """Fill NULL household counts from the literal estimates (51 rows:
    broadcast bounded by the literal)."""
    out = df.join(bounded_broadcast(dim), key, "left")
    return out.withColumn(target, F.coalesce(F.col(target), F.col("nb_menages_estime").cast(
        df.schema[target].dataType))).drop("nb_menages_estime")
