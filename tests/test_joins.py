"""Join helpers: size check, salted joins, scan spreading."""

from __future__ import annotations

import pytest

from propspark.operators import joins


def test_broadcast_only_when_estimate_is_small(spark):
    from pyspark.sql import functions as F
    small = spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    assert joins.is_small(small)
    assert not joins.is_small(small, max_bytes=0)
    # A side of unknown size (built from Python rows) is never hinted.
    unknown = spark.createDataFrame([(1, "a")], "k int, v string")
    assert joins.broadcast_if_small(unknown) is unknown or not joins.is_small(unknown)
    fact = spark.range(100).select(F.col("id").cast("int").alias("k"), F.col("id").cast("double").alias("x"))
    plan = fact.join(joins.broadcast_if_small(small), "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.createDataFrame([(i % 3, i) for i in range(200)] + [(9, 999)], "k int, v int")  # hot keys
    small = spark.createDataFrame([(0, "zero"), (1, "one"), (5, "five")], "k int, name string")
    plain = sorted(map(tuple, big.join(small, ["k"], how).collect()), key=repr)
    salted = sorted(map(tuple, joins.salted_join(big, small, ["k"], how, buckets=4).collect()), key=repr)
    assert plain == salted
    with pytest.raises(ValueError):
        joins.salted_join(big, small, ["k"], "full", buckets=4)

