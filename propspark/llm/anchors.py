"""Substring duplicates by difference-cover anchors.

A cover ``COVER`` modulo ``PERIOD`` holds, for every difference d, two members
that differ by d.  Hash ``window - PERIOD + 1`` words at cover positions only:
any two equal windows of ``window`` words then share an anchor at the same
place inside both, whatever their positions.  So a window that repeats
contains a repeated anchor, and only windows around repeated anchors are
extended to their full length and compared, by a 96-bit hash, in the order of
document and position: of equal windows all but the first are repeats.
Documents with the text of an earlier one repeat it whole and leave before
anchors are taken.

Hot passages: equal anchors (and equal windows) are first combined within a
chunk of documents, so a passage reaches the task of its hash once per chunk
however many documents hold it; the others are already known to repeat and
are dealt by other keys.  Lists per document are as long as the document.

Results for odd input: a null or empty text has no words; a null identifier
counts as the smallest; rows with the same identifier and text are one
document given twice (each gets the same result); rows with the same
identifier (or none) but other texts are documents of their own, with a 64-bit
hash of identifier and text in the identifier's place; an empty table gives an empty result; other columns are carried
through where asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propspark.llm.arrow_text import Words, chunks, gathered, mix, tidied, window_hash, window_starts
from propspark.llm.tables import written

WINDOW = 20
PERIOD = 13
#: Every difference modulo 13 is a difference of two of these.
COVER = (0, 1, 3, 9)
CHUNK = 2 << 20
_POS = np.int64((1 << 40) - 1)
_LEAST = -2**63


def _first_and_others(key: np.ndarray, doc: np.ndarray, ref: np.ndarray, second: np.ndarray | None = None):
    """Per row: is it the first of its key (by document and place), does its
    key occur again, and does the row itself occur before.  Rows keep their
    order, in which neighbours are alike and shuffle files compress well."""
    order = np.lexsort((ref, doc, key) if second is None else (ref, doc, second, key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if second is not None:
        s = second[order]
        new[1:] |= s[1:] != s[:-1]
    last = np.append(new[1:], True)
    twin = np.zeros(len(k), bool)
    twin[1:] = ~new[1:] & (doc[order][1:] == doc[order][:-1]) & (ref[order][1:] == ref[order][:-1])
    out = np.empty((3, len(k)), bool)
    out[:, order] = new, ~(new & last), twin
    return out


def _spread(key: np.ndarray, doc: np.ndarray, ref: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """The key where ``keep``, else a value that deals rows out evenly."""
    return np.where(keep, key, mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ ref.view(np.uint64)))


def _by_cell(cells: int, names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (the first column is their key) as one row of lists per cell:
    lists shuffle in a third of the space of rows."""
    cell = (columns[0].view(np.uint64) % np.uint64(cells)).astype(np.int32)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    cuts = np.flatnonzero(np.diff(cell, prepend=-1))
    ends = pa.array(np.append(cuts, len(cell)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(cell[cuts]), *lists], names=["cell", *names])


def _dealt_rows(lists: DataFrame, parts: int, names: list[str]) -> DataFrame:
    """Lists by cell, shuffled by cell and only then one row each."""
    dealt = lists.repartition(parts, "cell")
    return dealt.select("cell", F.inline(F.arrays_zip(*names)))


def _anchor_rows(width: int, cells: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, 2, 8 * CHUNK):
        ids, parts = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        for a, b, data, offsets in chunks(batch.column(2), CHUNK):
            words = Words(data, offsets)
            at = window_starts(words, width)
            owner = np.searchsorted(words.first, at, "right") - 1
            place = at - words.first[owner]
            hit = np.isin(place % PERIOD, COVER)
            at, owner, place = at[hit], owner[hit], place[hit]
            key = window_hash(words.hash, at, width)
            doc, ref = ids[a:b][owner], (parts[a:b][owner] << 40) | place
            first, again, _ = _first_and_others(key, doc, ref)
            if len(key):
                yield _by_cell(cells, ["k", "d", "ref", "known"],
                               [_spread(key, doc, ref, first).view(np.int64), doc, ref, again])


def _window_rows(window: int, width: int, cells: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reach = window - width  # the anchor begins at most so far inside a window
    for batch in gathered(batches, 2, 8 * CHUNK):
        ids, parts = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        lists = batch.column(4)
        for a, b, data, offsets in chunks(batch.column(2), CHUNK):
            words = Words(data, offsets)
            own = lists.slice(a, b - a)
            sizes = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            places = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(b - a), sizes)
            lo = words.first[owner] + np.maximum(places - reach, 0)
            hi = np.minimum(words.first[owner] + places, words.first[owner + 1] - window)
            good = hi >= lo
            mark = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(mark, lo[good], 1)
            np.add.at(mark, hi[good] + 1, -1)
            at = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
            owner = np.searchsorted(words.first, at, "right") - 1
            key, check = window_hash(words.hash, at, window, 1), window_hash(words.hash, at, window, 2)
            check = (check >> np.uint64(32)).astype(np.uint32).view(np.int32)
            doc, ref = ids[a:b][owner], (parts[a:b][owner] << 40) | (at - words.first[owner])
            first, _, twin = _first_and_others(key, doc, ref, check)
            keep = ~twin  # the same row given twice is no repeat of itself
            first, key, check, doc, ref = first[keep], key[keep], check[keep], doc[keep], ref[keep]
            if len(key):
                yield _by_cell(cells, ["k", "c", "d", "ref", "known"],
                               [_spread(key, doc, ref, first).view(np.int64), check, doc, ref, ~first])


def _result_rows(window: int, outputs: list[str], carry: list[str],
                 batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: d, s, text, row, places of repeated windows, whole copy."""
    for batch in batches:
        texts, lists, copies = batch.column(2), batch.column(4), batch.column(5).fill_null(False).to_pylist()
        row = batch.column(3).flatten()
        for a, b, data, offsets in chunks(texts, CHUNK):
            raw = data.tobytes()
            made = {o: [] for o in outputs}
            for i in range(b - a):
                words = raw[offsets[i]:offsets[i + 1]].split()  # splits at the same six bytes
                starts = lists[a + i].values
                n, kept = len(words), words
                if copies[a + i]:
                    kept = words if n < window else []
                elif starts is not None and len(starts):
                    mark = np.zeros(n + 1, np.int64)
                    s = np.unique(starts.to_numpy(zero_copy_only=False))
                    mark[s] += 1
                    mark[s + window] -= 1
                    stay = np.cumsum(mark)[:-1] == 0
                    kept = [w for w, k in zip(words, stay.tolist()) if k]
                made["n_words"].append(n)
                made["n_removed"].append(n - len(kept))
                text = b" ".join(kept)
                if "kept_text" in made:
                    made["kept_text"].append(text.decode())
                if "kept_sha256" in made:
                    made["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            columns = [c.slice(a, b - a) for c in row]
            columns += [pa.array(made[o], pa.int64() if o.startswith("n_") else pa.string()) for o in outputs]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *outputs])


def _copies(docs: DataFrame) -> DataFrame:
    """(__d, __s) of documents whose text an earlier one has."""
    light = docs.select("__d", "__s", F.xxhash64("__text").alias("t"), F.xxhash64(F.lit(1), "__text").alias("u"))
    key = F.struct("__d", "__s")
    firsts = (light.groupBy("t", "u").agg(F.min(key).alias("first"), F.max(key).alias("last"))
              .filter("first < last").drop("last"))
    # Written, so that the join can split a text with very many copies.
    return light.join(written(firsts, "copies"), ["t", "u"]).filter(key > F.col("first")).select("__d", "__s").distinct()


def _documents(rows: DataFrame) -> DataFrame:
    """``rows`` (__d, __text, ...) with a key of their own for each document:
    __d is the identifier and __s 0 where it has one text only (there is then
    nothing to join); else __d is a hash of both and __s is 1."""
    light = rows.select("__d", F.xxhash64("__text").alias("h"))
    shared = written(light.groupBy("__d").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
                     .filter("lo < hi").select("__d", F.lit(True).alias("__shared")), "shared-ids")
    if shared.isEmpty():
        # Zero, but no literal and never null, and of the type of the lists' numbers: else the passes get other
        # projections, filters and casts, and share no exchange.
        return rows.withColumn("__s", F.coalesce(F.pmod("__d", F.lit(1).cast("bigint")), F.lit(0).cast("bigint")))
    one = F.col("__shared").isNull()
    return (rows.join(shared, "__d", "left").withColumn("__s", F.when(one, 0).otherwise(1).cast("bigint"))
            .withColumn("__d", F.when(one, F.col("__d")).otherwise(F.xxhash64("__d", "__text"))).drop("__shared"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: list[str] | None = None,
                   outputs: tuple[str, ...] = ("n_words", "n_removed", "kept_text")) -> DataFrame:
    """``carry`` columns (default: the identifier) with ``outputs``: n_words,
    n_removed and kept_text and/or kept_sha256, after removing each word that
    lies in a window of ``window`` words which also starts earlier."""
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD} words")
    spark = df.sparkSession
    width = window - PERIOD + 1
    carry = [id_col] if carry is None else carry
    outputs = ["n_words", "n_removed", *[o for o in outputs if not o.startswith("n_")]]
    types = dict(df.dtypes)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = _documents(df.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_LEAST)).alias("__d"), text.alias("__text"),
                                F.struct(*[F.col(f"`{c}`") for c in carry]).alias("__row")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = 4 * parts
    copies = written(_copies(docs), "copies")
    # All three passes read the same exchange of the texts by document, with
    # the same columns: Spark runs it once.
    dealt = docs.repartition(parts, "__d", "__s")
    columns = ["__d", "__s", "__text", "__row"]

    # (An anti join would be pushed below the exchange, which then differs.)
    anchors = (dealt.join(copies.withColumn("__copy", F.lit(True)), ["__d", "__s"], "left")
               .filter("__copy IS NULL").select(*columns)
               .mapInArrow(lambda batches: tidied(_anchor_rows(width, cells, batches)),
                           "cell int, k array<bigint>, d array<bigint>, ref array<bigint>, known array<boolean>"))
    by_key = Window.partitionBy("cell").orderBy("k")
    anchors = (_dealt_rows(anchors, parts, ["k", "d", "ref", "known"])
               .withColumn("before", F.lag("k").over(by_key)).withColumn("after", F.lead("k").over(by_key))
               .filter(F.col("known") | (F.col("before") == F.col("k")) | (F.col("after") == F.col("k"))))

    def by_document(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(F.col("d").alias("__d"), F.shiftright("ref", 40).alias("__s"))
                .agg(F.collect_list(F.col("ref").bitwiseAND(F.lit(int(_POS)))).alias("__at")))

    windows = (dealt.join(by_document(anchors), ["__d", "__s"]).select(*columns, "__at")
               .mapInArrow(lambda batches: tidied(_window_rows(window, width, cells, batches)),
                           "cell int, k array<bigint>, c array<int>, d array<bigint>, ref array<bigint>, "
                           "known array<boolean>"))
    by_window = Window.partitionBy("cell").orderBy("k", "c", "known", "d", "ref")
    before = F.lag(F.struct("k", "c", "known", "d", "ref")).over(by_window)
    windows = _dealt_rows(windows, parts, ["k", "c", "d", "ref", "known"]).withColumn("before", before)
    same = (F.col("before.k") == F.col("k")) & (F.col("before.c") == F.col("c")) & ~F.col("before.known")
    twin = (F.col("before.d") == F.col("d")) & (F.col("before.ref") == F.col("ref"))
    repeats = windows.filter(F.col("known") | (same & ~twin)).select("d", "ref")

    found = by_document(repeats).withColumn("__copy", F.lit(False)).unionByName(
        copies.select("__d", "__s", F.lit(None).cast("array<bigint>").alias("__at"), F.lit(True).alias("__copy")))
    final = dealt.join(found, ["__d", "__s"], "left").select(*columns, "__at", "__copy")
    schema = ", ".join([f"`{c}` {types[c]}" for c in carry]
                       + [f"{o} {'bigint' if o.startswith('n_') else 'string'}" for o in outputs])
    return final.mapInArrow(lambda batches: tidied(_result_rows(window, outputs, carry, batches)), schema)
