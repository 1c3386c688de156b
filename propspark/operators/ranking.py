"""Global row numbers and exact quantiles without a single-task window.

``consecutive_ids`` (W3) numbers rows 1..N in ``order`` order:

1. range-partition on the order columns and a hash of the whole row, and
   sort inside partitions (one shuffle, sampled bounds, so neither a
   partition holds the whole table nor a task all rows of one key);
2. write the sorted frame once as a reliable checkpoint in the shared
   folder, so the counting pass and the numbering pass see the same
   partitions even if an executor is lost in between;
3. count rows per partition (one small row per partition reaches the
   driver: the count is bounded by the number of partitions, i.e. by
   spark.sql.shuffle.partitions, which the cluster sizes for its data);
4. id = offset of the partition + position inside it, where the position
   comes from ``monotonically_increasing_id`` (partition id in the upper
   bits, row index in the lower 33 bits).

``exact_quantiles`` (A16, A18) counts each distinct value first (a combining
aggregate, so a hot value is one row), writes the histogram sorted by value
once as a checkpoint, cumulates the counts over its partitions and reads the
values at ranks ``floor/ceil(q * (N - 1))``; linear interpolation between them
equals ``percentile`` / DuckDB ``quantile_cont``.  Counting and picking read
the same checkpoint, so the result does not depend on sampled range bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propspark.operators.joins import bounded_broadcast
from propspark.session import reliable_checkpoint


def consecutive_ids(df: DataFrame, order: list, id_col: str = "id",
                    num_partitions: int | None = None, start: int = 1) -> DataFrame:
    spark = df.sparkSession
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # Rows of one order key are told apart by a hash of the whole row, so ids
    # do not depend on the run and a hot key is cut by the splitters.
    plain = [c for c, t in df.dtypes if not t.startswith(("map<", "variant"))]
    order_cols.append(F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    # Without an explicit count the range exchange uses the cluster's
    # spark.sql.shuffle.partitions and AQE may merge adjacent small ranges,
    # which keeps the global order (partition ids stay in range order).
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols)).sortWithinPartitions(*order_cols)
    ranged = ranged.withColumn("_pid", F.spark_partition_id()) \
                   .withColumn("_mid", F.monotonically_increasing_id())
    ranged = reliable_checkpoint(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, acc = [], start
    for row in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((int(row["_pid"]), acc))
        acc += int(row["_n"])
    if not offsets:
        return ranged.drop("_pid", "_mid").withColumn(id_col, F.lit(None).cast("long"))
    # One row per partition: bounded by the partition count.
    off_df = bounded_broadcast(spark.createDataFrame(offsets, "_pid int, _off long"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(off_df, "_pid")
            .withColumn(id_col, (F.col("_off") + local).cast("long"))
            .drop("_pid", "_mid", "_off"))


def exact_quantiles(df: DataFrame, col: str, qs: list[float]) -> dict[float, float | None]:
    """Exact linear-interpolation quantiles of ``col``; NULL and NaN excluded.

    Returns a dict q -> value (scalars only reach the driver)."""
    return column_quantiles(df, [col], qs)[col]


def column_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> dict[str, dict[float, float | None]]:
    """``exact_quantiles`` of several columns in one pass over ``df`` and one
    checkpoint of the histograms."""
    values = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    counts = (df.select(F.explode(values).alias("x")).select("x.c", "x.v")
              .filter(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    hist = reliable_checkpoint(counts.repartitionByRange("c", "v").sortWithinPartitions("c", "v")
                               .withColumn("_pid", F.spark_partition_id()))
    # One row per column and partition: bounded by the partition count.
    parts = sorted((r["c"], r["_pid"], int(r["n"]))
                   for r in hist.groupBy("c", "_pid").agg(F.sum("n").alias("n")).collect())
    totals = [sum(n for c, _, n in parts if c == i) for i in range(len(cols))]

    def place(total: int, q: float) -> tuple[int, int, float]:
        pos = q * (total - 1)
        lo = int(pos // 1)
        return lo, min(lo + 1, total - 1), pos - lo

    wanted = []  # (column, partition, rank within the partition, rank)
    for i, total in enumerate(totals):
        ranks = sorted({r for q in qs for r in place(total, q)[:2]}) if total else []
        ahead = 0
        for c, pid, n in parts:
            if c == i:
                wanted += [(c, pid, r - ahead, r) for r in ranks if ahead <= r < ahead + n]
                ahead += n
    picked: dict[tuple[int, int], float] = {}
    if wanted:
        marks = bounded_broadcast(df.sparkSession.createDataFrame(wanted, "c int, _pid int, at long, r long"))
        upto = Window.partitionBy("c", "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        pids = df.sparkSession.createDataFrame(sorted({w[:2] for w in wanted}), "c int, _pid int")
        cum = hist.join(bounded_broadcast(pids), ["c", "_pid"]).withColumn("upto", F.sum("n").over(upto))
        hits = cum.join(marks, ["c", "_pid"]).filter((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
        picked = {(r["c"], r["r"]): r["v"] for r in hits.select("c", "r", "v").collect()}
    out = {}
    for i, c in enumerate(cols):
        out[c] = {}
        for q in qs:
            if not totals[i]:
                out[c][q] = None
                continue
            lo, hi, frac = place(totals[i], q)
            a, b = picked[i, lo], picked[i, hi]
            out[c][q] = a + (b - a) * frac if frac else a
    return out
