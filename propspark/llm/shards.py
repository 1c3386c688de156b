"""Shards by longest-processing-time scheduling.

Groups of equal texts stay together.  Groups, sorted by size, go to the
least-loaded shard.  Scheduling needs only how many groups there are of each
size: sizes keep ``SIZE_BITS`` leading bits (exact below 2^SIZE_BITS), which
bounds the number of size classes by about 2^(SIZE_BITS-1) per doubling, and
each class is further cut by a hash into pieces of about ``PIECE_GROUPS``
groups.  A heap over the shards places the classes in descending order of
size on the driver: equal sized groups are first levelled in bulk and the
rest placed one by one from the heap, which gives what one-by-one placement
gives.  Groups are then numbered within their piece on the executors and take
the shard of their number.  Nothing per document or per group reaches the
driver.

Results for odd input: a null text has size ``OVERHEAD`` and forms one group
with the empty texts; repeated rows count each on their own and stay
together; a null identifier takes part like any other; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propspark.llm.tables import written

OVERHEAD = 8
SIZE_BITS = 12
PIECE_GROUPS = 1 << 16
SLOT_ROWS = 1 << 14


def lpt_quotas(classes: list[tuple[float, int]], shards: int) -> list[list[int]]:
    """For classes (size, count), given in descending size: how many groups
    of each class go to each shard when every group in turn goes to the
    least-loaded shard (the lower number on ties)."""
    heap = [(0.0, j) for j in range(shards)]
    out = []
    for size, count in classes:
        quota = [0] * shards
        if count > 2 * shards and size > 0:
            # All shards below the level reached with count - shards groups
            # are filled to it in bulk; one-by-one placement passes there too.
            loads = sorted(heap)
            level, width, room = loads[0][0], 0, 0.0
            bulk = (count - shards) * size
            while width < shards:
                width += 1
                top = loads[width][0] if width < shards else float("inf")
                step = (top - level) * width
                if room + step >= bulk:
                    level += (bulk - room) / width
                    break
                room += step
                level = top
            heap = []
            for load, j in loads:
                q = max(0, int((level - load) // size))
                quota[j] = q
                count -= q
                heap.append((load + q * size, j))
            heapq.heapify(heap)
        for _ in range(count):
            load, j = heap[0]
            heapq.heapreplace(heap, (load + size, j))
            quota[j] += 1
        out.append(quota)
    return out


def assign_shards(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  overhead: int = OVERHEAD) -> DataFrame:
    """Per row of ``df``: doc_id, size, text_crc32, shard and slot (numbers
    from 0 without gaps within the shard)."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = written(df.select(F.col(f"`{id_col}`").alias("doc_id"),
                             (F.octet_length(text) + overhead).cast("long").alias("size"),
                             F.crc32(text).alias("text_crc32"),
                             F.unhex(F.sha2(text, 256)).alias("g")), "shard-rows")
    bits = F.floor(F.log2(F.col("bytes").cast("double"))).cast("int") + 1
    shift = F.greatest(bits - SIZE_BITS, F.lit(0))
    groups = (rows.groupBy("g").agg(F.sum("size").alias("bytes"))
              .withColumn("shift", shift)
              .withColumn("class", F.expr("shiftleft(shiftright(bytes, shift), shift)"))
              .drop("shift"))
    # Pieces of a class: as many as its number of groups asks for.
    counts = groups.groupBy("class").agg(F.count(F.lit(1)).alias("m"))
    pieces = counts.select("class", F.ceil(F.col("m") / PIECE_GROUPS).cast("int").alias("pieces"))
    groups = (groups.join(pieces, "class")
              .withColumn("piece", F.pmod(F.xxhash64("g"), F.col("pieces")).cast("int")))
    groups = written(groups.select("g", "bytes", "class", "piece"), "shard-groups")

    # Bounded: size classes times pieces of 2^16 groups.
    histogram = (groups.groupBy("class", "piece")
                 .agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("b")).collect())
    histogram.sort(key=lambda r: (-r["class"], r["piece"]))
    quotas = lpt_quotas([(r["b"] / r["m"], r["m"]) for r in histogram], shards)
    cuts = []
    for r, quota in zip(histogram, quotas):
        upto, ends = 0, []
        for q in quota:
            upto += q
            ends.append(upto)
        cuts.append((r["class"], r["piece"], ends))
    cuts = spark.createDataFrame(cuts, "class long, piece int, ends array<long>")
    numbered = Window.partitionBy("class", "piece").orderBy("g")
    placed = (groups.withColumn("at", F.row_number().over(numbered))
              .join(cuts, ["class", "piece"])
              .select("g", F.size(F.filter("ends", lambda e: e < F.col("at"))).alias("shard")))
    placed = written(placed, "shard-placed")

    # Slots: rows are numbered in hash parts of each shard, behind the rows of
    # the parts before (shards x parts counts).
    parts = max(1, ceil(rows.count() / (SLOT_ROWS * shards)) * 2)
    sharded = (rows.join(placed, "g")
               .withColumn("part", F.pmod(F.xxhash64("doc_id", "g"), F.lit(parts)).cast("int")))
    sharded = written(sharded.drop("g"), "shard-sharded")
    counts = sharded.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("m"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (sharded.withColumn("n", F.row_number().over(within))
            .join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("ahead") + F.col("n") - 1).cast("long").alias("slot")))
