"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case.  Fixed masks over
``SPAN`` words ignore some positions, so a seed still hits when the words
there were substituted.  Every window of every benchmark item and of every
document is hashed under each mask; equal hashes are hits.  Around each hit
the two word sequences are compared position by position over ``REACH`` words
to either side: the overlap is the best-scoring run of positions, an equal
word counting 1 and a substituted one ``-MISMATCH``; it contaminates when it
scores ``MIN_SCORE`` or, for a shorter item, when all the item's words agree.
An item of ``SPAN`` to ``ONE_OFF - 1`` words also contaminates when all its
words but one agree; the first or the last four of them then agree, which are
seeds of their own.

Only DataFrame functions.  Before windows of documents leave their row they
are tested against a bitmap of the benchmark's hashes (a fixed number of
bits; false alarms are removed by the join, misses do not occur), so only
hits and rare false alarms are shuffled or joined, each with its own
surroundings: texts are read once and never shuffled.  The benchmark's
windows are broadcast only if their counted size is below
``BROADCAST_BYTES``, else joined by a shuffle that splits hot hashes.

Results for odd input: null and empty texts have no words and no hits; items
of fewer than ``SPAN`` words are compared whole, word for word; repeated rows
give one result row; several hits of one document and item give one row with
the best overlap; a null identifier stays null; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propspark.llm.tables import written

#: A mask is the places of its pairs of adjacent words in the span: 11011011,
#: 110011011 and 1111011, where 1 counts and 0 is ignored.  The last leaves
#: out every fifth word.
MASKS = ((0, 3, 6), (0, 4, 7), (0, 2, 5))
#: Four words in a row: the ends of items below ``ONE_OFF`` words.
ENDS = (0, 2)
ENDS_SPAN = 4
ONE_OFF = 15
SPAN = 9
REACH = 24
MISMATCH = 2
MIN_SCORE = 12
BITMAP_WORDS = 1 << 16
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(cut, lambda w: w != ""), lambda w: F.xxhash64(w))


def word_pairs(w: Column) -> Column:
    """Hash of each word with the next; the last stands alone."""
    return F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1)))


def _seeds(pairs: Column, mask: tuple[int, ...], number: int, span: int = SPAN) -> Column:
    """Hash of every window under a mask."""
    last = F.size(pairs) - span
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(number), *[F.get(pairs, i + k) for k in mask]))


def _around(w: Column, at: Column) -> tuple[Column, Column]:
    """(position of ``at`` within the slice, the words around it)."""
    left = F.greatest(at - REACH, F.lit(0))
    return at - left, F.slice(w, left + 1, REACH * 2 + SPAN)


def _bit(h: Column) -> tuple[Column, Column]:
    """Word of a hash in the bitmap, and its bit (of which six bits count)."""
    return h.bitwiseAND(F.lit(BITMAP_WORDS - 1)).cast("int"), F.shiftrightunsigned(h, 20).bitwiseAND(63).cast("int")


def index_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per mask and window of the items: hash, item, position in the
    slice, slice of words, and the item's number of words."""
    base = items.select(F.col(f"`{id_col}`").alias("item_id"), words(F.col(f"`{text_col}`")).alias("w"))
    base = base.select("*", word_pairs(F.col("w")).alias("pairs"))
    parts = []
    one_off = (F.size("w") >= SPAN) & (F.size("w") < ONE_OFF)
    ends = base.filter(one_off).select("item_id", "w", F.posexplode(_seeds(F.col("pairs"), ENDS, len(MASKS), ENDS_SPAN)).alias("q", "h"))
    families = [base.select("item_id", "w", F.posexplode(_seeds(F.col("pairs"), mask, number)).alias("q", "h"))
                for number, mask in enumerate(MASKS)]
    for seeds in [*families, ends.filter((F.col("q") == 0) | (F.col("q") == F.size("w") - ENDS_SPAN))]:
        at, near = _around(F.col("w"), F.col("q"))
        parts.append(seeds.select("h", "item_id", at.alias("q"), near.alias("item_words"),
                                  F.size("w").alias("n")))
    short = base.filter((F.size("w") > 0) & (F.size("w") < SPAN))
    parts.append(short.select(_short(F.col("w")).alias("h"), "item_id", F.lit(0).alias("q"),
                              F.col("w").alias("item_words"), F.size("w").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _short(w: Column) -> Column:
    """Hash of a whole item of fewer than SPAN words."""
    return F.aggregate(w, F.lit(41).cast("bigint"), lambda a, x: F.xxhash64(a, x))


def _short_seeds(w: Column, n: int) -> Column:
    """Hashes of all runs of n words, for items of just n words."""
    last = F.size(w) - n
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: _short(F.slice(w, i + 1, n)))


def find_overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Contaminated pairs: doc_id, item_id, score, matched (equal words),
    words (length of the overlap)."""
    index = written(index_items(items, item_id, item_text), "seeds")
    n_index, lengths = index.count(), [r["n"] for r in index.select("n").filter(F.col("n") < ONE_OFF).distinct().collect()]
    word, bit = _bit(F.col("h"))
    # Bounded by the fixed size of the bitmap.
    cells = (index.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("b"))
             .groupBy("word").agg(F.bit_or("b").alias("b")).collect())
    bits = [0] * BITMAP_WORDS
    for r in cells:
        bits[r["word"]] = r["b"]
    bitmap = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")  # folded to one constant

    w = F.col("w")
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words(F.col(f"`{text_col}`")).alias("w"))
    base = base.select("doc_id", "w", word_pairs(w).alias("pairs"))

    def known(h: Column) -> Column:
        word, bit = _bit(h)
        return F.call_function("shiftrightunsigned", F.get(bitmap, word), bit).bitwiseAND(1) == 1

    def hits(seeds: Column) -> Column:
        marked = F.transform(seeds, lambda h, i: F.when(known(h), F.struct(i.alias("p"), h.alias("h"))))
        return F.filter(marked, lambda s: s.isNotNull())

    found = [hits(_seeds(F.col("pairs"), mask, number)) for number, mask in enumerate(MASKS)]
    if any(n >= SPAN for n in lengths):
        found.append(hits(_seeds(F.col("pairs"), ENDS, len(MASKS), ENDS_SPAN)))
    found += [hits(_short_seeds(w, n)) for n in lengths if n < SPAN]
    spots = base.select("doc_id", "w", F.explode(F.concat(*found)).alias("s"))
    at, near = _around(w, F.col("s.p"))
    spots = spots.select("doc_id", F.col("s.h").alias("h"), at.alias("p"), near.alias("doc_words"))
    if n_index * (REACH * 2 + SPAN + 8) * 8 <= BROADCAST_BYTES:
        index = F.broadcast(index)
    pairs = spots.join(index, "h").drop("h")

    # Position by position along the diagonal of the hit.
    back = F.least("p", "q")
    ahead = F.least(F.size("doc_words") - F.col("p"), F.size("item_words") - F.col("q"))
    same = F.zip_with(F.slice("doc_words", F.col("p") - back + 1, back + ahead),
                      F.slice("item_words", F.col("q") - back + 1, back + ahead), lambda a, b: a == b)
    start = F.struct(*[F.lit(0).alias(c) for c in ("run", "eq", "len", "score", "matched", "words")])

    def step(a: Column, equal: Column) -> Column:
        run = a["run"] + F.when(equal, 1).otherwise(-MISMATCH)
        eq, length = a["eq"] + F.when(equal, 1).otherwise(0), a["len"] + 1
        new = run <= 0
        better = run > a["score"]
        return F.struct(F.when(new, 0).otherwise(run).alias("run"), F.when(new, 0).otherwise(eq).alias("eq"),
                        F.when(new, 0).otherwise(length).alias("len"),
                        F.when(better, run).otherwise(a["score"]).alias("score"),
                        F.when(better, eq).otherwise(a["matched"]).alias("matched"),
                        F.when(better, length).otherwise(a["words"]).alias("words"))

    # A whole item below ONE_OFF words lies within REACH of any of its places.
    scored = pairs.select("doc_id", "item_id", "n", F.aggregate(same, start, step).alias("o"),
                          F.size(F.filter(same, lambda x: x)).alias("equal"))
    one_off = F.col("n").between(SPAN, ONE_OFF - 1) & (F.col("equal") >= F.col("n") - 1)
    enough = (F.col("o.score") >= F.least(F.lit(MIN_SCORE), F.col("n"))) | one_off
    best = (scored.filter(enough).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("o.score", "o.matched", "o.words")).alias("o")))
    return best.select("doc_id", "item_id", "o.score", "o.matched", "o.words")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap an item.  Rows are known by
    identifier; a null identifier is dropped if some such row overlaps."""
    bad = written(find_overlaps(docs, items, id_col, text_col).select(F.col("doc_id").alias("__bad")).distinct(),
                  "contaminated")
    return docs.join(bad, docs[f"`{id_col}`"].eqNullSafe(bad["__bad"]), "left_anti")
