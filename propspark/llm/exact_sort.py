"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts; an external sort
puts equal texts next to each other; each row is compared in full with its
neighbour, so digests decide nothing.  Only DataFrame functions.

A text that holds a large part of all rows meets splitters that differ only
in the identifier, so its rows lie in many ranges.  The (at most
``MAX_SPLITTERS``) texts cut by a splitter are counted once more with a
combining aggregate, whose result is bounded by the number of splitters.

Results for odd input: a null text counts as empty; equal empty texts are
one group; a null identifier sorts below all others; of repeated rows with
the same identifier exactly one is kept; an empty table gives an empty
result; other columns are carried through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propspark.llm import ranges

PREFIX_CHARS = 48
TARGET_BYTES = 4 << 20
_KEY = "struct<p:string,s:string,i:bigint>"


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] | None = None,
                 keep: str = "max", target_bytes: int = TARGET_BYTES,
                 carry: list[str] | None = None) -> DataFrame:
    """All rows of ``df`` as ``row`` (a struct of the columns ``carry``, by
    default all) with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``keep``: ``"max"`` or ``"min"``, which identifier of a group stays."""
    if keep not in ("max", "min"):
        raise ValueError("keep must be 'max' or 'min'")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    if normalise is not None:
        text = F.coalesce(normalise(text), F.lit(""))
    best = F.max if keep == "max" else F.min
    base = df.select(F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row"),
                     F.col(f"`{id_col}`").cast("bigint").alias("i"), text.alias("t"))
    light = base.select("i", F.substring("t", 1, PREFIX_CHARS).alias("p"), "t")

    n = df.count()
    sample = ranges.sample_rows(light.select("p", F.sha2("t", 256).alias("s"), "i",
                                             F.octet_length("t").alias("b")), n)
    mean = sum(r["b"] + 32 for r in sample) / max(1, len(sample))
    buckets, parts = ranges.buckets_for(mean * n, target_bytes)
    splitters = ranges.pick_splitters([(r["p"], r["s"], r["i"]) for r in sample], buckets)
    cut_texts = sorted({k[1] for k in splitters})
    cut_prefixes = sorted({k[0] for k in splitters})

    keyed = base.withColumn("p", F.substring("t", 1, PREFIX_CHARS)).withColumn("s", F.sha2("t", 256))
    is_cut = F.col("s").isin(cut_texts) if cut_texts else F.lit(False)
    keyed = (keyed.withColumn("bucket", ranges.bucket_of(F.struct("p", "s", "i"), splitters, _KEY))
             .withColumn("cut", is_cut)
             .withColumn("part", F.pmod(F.when(F.col("cut"), F.xxhash64("i")).otherwise(F.xxhash64("s")),
                                        F.lit(parts)).cast("int")))

    id_order = F.col("i").desc_nulls_last() if keep == "max" else F.col("i").asc_nulls_last()
    cell = Window.partitionBy("bucket", "part")
    sweep = cell.orderBy(F.col("t"), id_order)
    before = F.lag("t").over(sweep)
    # Position and neighbour come from one sorted pass; the text ends there.
    runs = (keyed.select("row", "i", "s", "bucket", "part", "cut", "t",
                         F.row_number().over(sweep).alias("at"), before.alias("before"))
            .withColumn("first", F.col("before").isNull() | (F.col("before") != F.col("t")))
            .drop("t", "before"))
    in_cell = Window.partitionBy("bucket", "part").orderBy("at")
    runs = runs.withColumn("run", F.sum(F.col("first").cast("long")).over(in_cell))
    group = Window.partitionBy("bucket", "part", "run")
    runs = runs.select("*", F.count(F.lit(1)).over(group).alias("n"), best("i").over(group).alias("k"))

    if cut_texts:
        over_ranges = (light.filter(F.col("p").isin(cut_prefixes))
                       .select("i", F.sha2("t", 256).alias("s")).filter(F.col("s").isin(cut_texts))
                       .groupBy("s").agg(F.count(F.lit(1)).alias("cut_n"), best("i").alias("cut_k")))
        runs = runs.join(F.broadcast(over_ranges), "s", "left")  # at most MAX_SPLITTERS rows
    else:
        runs = runs.withColumn("cut_n", F.lit(None).cast("long")).withColumn("cut_k", F.lit(None).cast("long"))
    whole = F.col("cut_n").isNotNull()
    return (runs.withColumn("keep_id", F.when(whole, F.col("cut_k")).otherwise(F.col("k")))
            .select("row", "keep_id",
                    F.when(whole, F.col("cut_n")).otherwise(F.col("n")).cast("long").alias("group_size"),
                    (F.col("first") & F.col("i").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    F.col("s").alias("text_sha256")))


def drop_exact(df: DataFrame, **kwargs) -> DataFrame:
    """``df`` with one row of each group of equal texts."""
    return exact_groups(df, **kwargs).filter("kept").select("row.*")
