"""Catalog and exploration (C1-C4, L4, K5) as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """K5: named temp views (re-registering replaces, Q13)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table its row count, column count and column list with types.

    Each count is a separate scan; they are unioned into one result."""
    parts = []
    for name, df in tables.items():
        cols = ", ".join(f"{c} {t}" for c, t in df.dtypes)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count"),
            F.lit(len(df.columns)).alias("column_count"), F.lit(cols).alias("columns"),
            F.lit(", ".join(df.columns)).alias("column_names")))
    return reduce(DataFrame.unionByName, parts)


def catalog_listing(spark: SparkSession, names: list[str] | None = None, count: bool = True) -> DataFrame:
    """C1/C2 from the session catalog: name, kind (view or table), column
    count, columns with types, column names and, for tables, the row count.

    Names, kinds and columns are metadata, no table is read for them.  Row
    counts read no column: of Parquet tables only the footers."""
    found = {t.name: t for t in spark.catalog.listTables()}
    rows, counts = [], []
    for name in sorted(found) if names is None else names:
        df = spark.table(f"`{name}`")
        kind = "view" if found[name].tableType in ("TEMPORARY", "VIEW") else "table"
        rows.append((name, kind, len(df.columns), ", ".join(f"{c} {t}" for c, t in df.dtypes), ", ".join(df.columns)))
        if count and kind == "table":
            counts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count"))
    listed = spark.createDataFrame(rows, "name string, kind string, column_count int, columns string, column_names string")
    if not counts:
        return listed.withColumn("row_count", F.lit(None).cast("bigint"))
    return listed.join(F.broadcast(reduce(DataFrame.unionByName, counts)), "name", "left")  # one row per table


def table_preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First n rows (by ``order`` when given, for a stable preview)."""
    return (df.orderBy(*order) if order else df).limit(n)


def adhoc_sql(spark: SparkSession, query: str) -> DataFrame:
    """C4: run SQL against the registered views."""
    return spark.sql(query)
