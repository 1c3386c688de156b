"""The shared checkpoint folder is read from the session, never replaced."""

from __future__ import annotations

from propspark.session import checkpoint_dir, configure, reliable_checkpoint


def test_checkpoint_dir_follows_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    got = checkpoint_dir(spark)
    assert named and got and (named.rstrip("/") in got or got.rstrip("/") in named or named in got)


def test_reliable_checkpoint_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS v")
    ck = reliable_checkpoint(df)
    assert ck.count() == 100
    plan = ck._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan                       # lineage replaced by the checkpoint


def test_configure_keeps_existing_settings(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
