"""Reading the corpus tables and cutting lineage in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from propspark.session import checkpoint_dir


#: Texts in one Arrow batch, which JVM and worker both hold: a few MB of
#: ordinary documents instead of the 10,000 rows of Spark's default.
BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it,
    whatever folder the driver was started in, and bounds their batches where
    the session leaves that at its default."""
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``,
    read again.  Survives lost executors, and unlike a checkpoint it keeps
    column pruning."""
    spark = df.sparkSession
    find_package(spark)
    path = os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(df: DataFrame, carry: list[str] | None, outputs: Iterable[str]) -> list[str]:
    """Columns to carry (default: all) but those named like an output, which
    the output replaces, as ``withColumn`` does."""
    taken = {o.lower() for o in outputs}
    return [c for c in (df.columns if carry is None else carry) if c.lower() not in taken]


def spare_name(columns: Iterable[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
