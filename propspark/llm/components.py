"""Connected components by alternating large and small stars.

Edges (a, b) are rewired until every node points at the smallest node of its
component; the number of rounds grows with the logarithm of the graph.  Each
round is a combining minimum per node and a join back, so a node with very
many edges is split by adaptive execution; edges are written to the shared
folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Points the neighbours of each node u at the least of them and u:
    neighbours above u (large), or u and those below it (small)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b: bigint) but the roots."""
    edges = written(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    state = None
    while True:
        edges = written(_star(_star(edges, True), False), "edges")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(new)
