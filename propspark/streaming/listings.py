"""Incremental listing load on Structured Streaming (K4 fed by new files).

Listing drops arrive as JSON files in a folder.  A file-source stream types
each micro-batch (F17-F19) and appends it to a Parquet log, one folder per
batch id, written with ``overwrite`` so a retried batch replaces itself
(idempotent ``foreachBatch``; the stream checkpoint records progress).
The current ``annonces`` / ``diagnostics`` / ``images`` tables are the
last-wins view of the whole log (``build_listings``), recomputed in batch
when needed: no table is rewritten in place.

Order of records: the ingest sequence is (file modification time, batch
id, position in the batch).  A JSON array file is read by one task in file
order, so the position follows the order inside a file.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propspark.operators.listings import build_listings
from propspark.sources.listings import LISTING_SCHEMA, type_listing


def _typed_batch(batch: DataFrame, batch_id: int) -> DataFrame:
    seq = F.struct(F.col("_mtime").alias("mtime"), F.lit(batch_id).cast("long").alias("batch"),
                   F.monotonically_increasing_id().alias("pos"))
    return type_listing(batch).withColumn("ingest_seq", seq).drop("_mtime")


def start_listing_ingest(spark: SparkSession, in_dir: str, log_dir: str, checkpoint_location: str,
                         multiline: bool = True, available_now: bool = True):
    """Start the ingest stream; returns the StreamingQuery."""
    src = (spark.readStream.schema(LISTING_SCHEMA).option("multiLine", multiline).json(in_dir)
           .withColumn("_mtime", F.col("_metadata.file_modification_time")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (_typed_batch(batch, batch_id).write.mode("overwrite")
         .parquet(os.path.join(log_dir, f"batch={batch_id}")))

    w = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def current_listings(spark: SparkSession, log_dir: str) -> dict[str, DataFrame]:
    """Last-wins listing tables over the whole ingest log."""
    return build_listings(spark.read.parquet(log_dir).drop("batch"))
