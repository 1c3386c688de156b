"""Spark session settings and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only
fills in what is unset.  ``checkpoint_dir`` never invents a machine-local
folder when the cluster already names one in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
# Settings fixed when the context starts; ``configure`` leaves them alone.
STATIC_CONF = {"spark.ui.enabled", "spark.cleaner.referenceTracking.cleanCheckpoints"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "propspark", extra: dict | None = None,
                  checkpoint: str | None = None) -> SparkSession:
    """Session for tests and the local bench.  Cluster jobs get theirs
    from the platform and should call :func:`configure` instead."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    own = checkpoint or tempfile.mkdtemp(prefix="propspark-ckpt-")
    for k, v in {"spark.checkpoint.dir": own, **DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF where the session leaves a key unset."""
    for k, v in DEFAULT_CONF.items():
        if k in STATIC_CONF:
            continue  # only settable when the context starts
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Reads ``spark.checkpoint.dir`` from the session, on every master alike.
    A session without it gets a folder in its warehouse, which all executors
    share too; ``build_session`` (tests, bench) names a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Survives executor loss (data lives in the checkpoint dir, not in
    executor memory); ``localCheckpoint`` is deliberately not used.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df, name: str):
    """``df`` written as Parquet in the shared folder and read again: cuts
    lineage like a reliable checkpoint, and keeps column pruning."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
