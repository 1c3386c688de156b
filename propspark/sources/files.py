"""File sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propspark.constants import (CENSUS_NULL_TEXT, COMMUNE_CODE_PATTERN,
                                 DEPARTMENT_CODE_PATTERN, RAW_SALES_COLUMNS)


def all_string_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


# S1 -------------------------------------------------------------------------
def read_raw_sales(spark: SparkSession, paths, columns: list[str] = RAW_SALES_COLUMNS,
                   sep: str = ",") -> DataFrame:
    """Many per-department CSV files, every column as STRING.

    ``enforceSchema=False`` checks each file's header against the schema, so
    a file whose columns come in another order raises instead of being
    silently mis-bound.  Empty files contribute no rows.  The source file is
    kept in ``_source_file`` (used by ``empty_partitions``).
    """
    return (spark.read.schema(all_string_schema(columns))
            .option("header", True).option("enforceSchema", False).option("sep", sep)
            .option("mode", "FAILFAST")
            .csv(paths if isinstance(paths, (list, tuple)) else [paths])
            .withColumn("_source_file", F.col("_metadata.file_path")))


# S2 -------------------------------------------------------------------------
def empty_partitions(expected: DataFrame, df: DataFrame, key: str, df_key: str | None = None) -> DataFrame:
    """Expected partition keys (e.g. departments) that produced no row."""
    present = df.select(F.col(df_key or key).alias(key)).distinct()
    return expected.join(present, key, "left_anti")


def empty_files(spark: SparkSession, paths, df: DataFrame, file_col: str = "_source_file") -> DataFrame:
    """Files under ``paths`` (column path) that gave ``df`` no row: empty
    ones and those with a header only.  The files come from the reader's own
    index, which the driver holds anyway; nothing is read for it."""
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, (list, tuple)) else [paths]).inputFiles()
    # The index writes file:///, the metadata column may write file:/; both escape the names.
    listed = [(re.sub("^file:/+", "file:/", p),) for p in listed]
    present = df.select(F.regexp_replace(file_col, "^file:/+", "file:/").alias("path")).distinct()
    return spark.createDataFrame(listed, "path string").join(present, "path", "left_anti")


# S3 S4 ----------------------------------------------------------------------
def read_series(spark: SparkSession, path, sep: str = ";") -> DataFrame:
    """Monthly series CSV with header; values stay text (comma decimals)."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("encoding", "UTF-8").option("inferSchema", False).csv(path))


# S5 -------------------------------------------------------------------------
def read_census(spark: SparkSession, path, columns: list[str], level: str = "departement",
                sep: str = ";", null_text: str = CENSUS_NULL_TEXT) -> DataFrame:
    """Census CSV with preamble lines and a text NULL sentinel.

    Spark CSV cannot skip rows, so the file is read without header against a
    positional all-STRING schema and only rows whose first column is a valid
    code are kept (preamble and header lines fail the pattern).
    """
    pattern = DEPARTMENT_CODE_PATTERN if level == "departement" else COMMUNE_CODE_PATTERN
    df = (spark.read.schema(all_string_schema(columns)).option("header", False)
          .option("sep", sep).option("nullValue", null_text).csv(path))
    code = columns[0]
    return df.filter(F.regexp_replace(F.col(code), "^﻿", "").rlike(pattern))


# S6 -------------------------------------------------------------------------
def read_table(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


# S9 -------------------------------------------------------------------------
def read_departments(spark: SparkSession, path, code: str = "code_departement",
                     name: str = "nom_departement") -> DataFrame:
    return (spark.read.option("header", True).csv(path)
            .select(F.col(code).cast("string").alias(code), F.col(name).alias(name)))


# K1 K2 ----------------------------------------------------------------------
def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as table ``name`` at ``path``, bucketed and sorted by ``key``:
    tables with as many buckets join on it without a shuffle.  One file per
    bucket, as the rows are dealt by the same hash before."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
