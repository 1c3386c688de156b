"""Near duplicates by BagMinHash.

A text is the multiset of its runs of ``SHINGLE`` words.  Every shingle with
weight w (its count) has Poisson processes over the weight axis, cut at the
powers of two: the piece (2^(k-1), 2^k] has points at rate 2^(k-1), each at a
uniform weight in the piece and in a uniform component of the signature, all
drawn from a hash of shingle, piece and number of the point.  Points above w
do not count.  A component's signature is the earliest point in it, so two
texts agree in a component with the probability of their weighted Jaccard
similarity.  Points are generated in rounds, and a process stops when its time
is past the latest component of its text, so long texts cost about one point
per shingle.

``BANDS`` bands of ``ROWS`` components are hashed; texts that share a band are
candidates, and candidates are verified on their whole multisets.  At
similarity 0.8 a pair shares no band with probability 1e-4 (0.85: 3e-7).

Classes are the connected components of the links.  Texts with equal
multisets are one node.  In each band's bucket all nodes are first verified
against one leader, the member nearest the middle; then, only in buckets that
still hold several components, the pairs of different components are verified
that remain possible by the triangle inequality (1 - similarity is a metric),
by what both lack of the leader and by the shingles that no other text has.  No link is lost
to a cap, and copies are not expanded into pairs.

Results for odd input: fewer than ``SHINGLE`` words are one shingle; null and
empty texts have no shingles and are near nothing, each its own class; a null
identifier is carried through and is the least only of a class without
others; repeated rows share their class, of which one row is kept; an empty table gives an empty result; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propspark.llm.arrow_text import Words, chunks, mix, tidied, window_hash
from propspark.llm.components import components
from propspark.llm.tables import find_package, spare_name, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 7
CHUNK = 1 << 20
#: Documents whose points are drawn at once, some 5 m for each in a round.
DOCS_AT_ONCE = 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_TICKS = 2.0**32


def multisets(words: Words, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, count) of a chunk, in the order of both."""
    n = np.where(words.count >= shingle, words.count - shingle + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    key = window_hash(words.hash, at, shingle)
    few = np.flatnonzero((words.count > 0) & (words.count < shingle))
    if len(few):
        short = [window_hash(words.hash, words.first[few[words.count[few] == k]], k, k) for k in range(1, shingle)]
        owner = [few[words.count[few] == k] for k in range(1, shingle)]
        doc, key = np.concatenate([doc, *owner]), np.concatenate([key, *short])
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    return doc[start], key[start], np.diff(np.append(start, len(key)))


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """(n_docs, m) earliest points; a document without shingles has zeros.
    ``doc`` is in order."""
    out = np.zeros((n_docs, m), np.uint64)
    for a in range(0, n_docs, DOCS_AT_ONCE):
        some = slice(*np.searchsorted(doc, [a, a + DOCS_AT_ONCE]))
        out[a:a + DOCS_AT_ONCE] = _points(doc[some] - a, key[some], count[some], min(DOCS_AT_ONCE, n_docs - a), m)
    return out


def _points(doc: np.ndarray, key: np.ndarray, count: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    best = np.full(n_docs * m, np.iinfo(np.int64).max)
    sig = np.zeros(n_docs * m, np.uint64)
    # A process for each shingle and piece of the weight axis below its count.
    pieces = 1 + np.ceil(np.log2(count)).astype(np.int64)
    p = np.repeat(np.arange(len(doc)), pieces)
    piece = np.arange(len(p)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    owner, weight = doc[p], count[p]
    width = np.where(piece == 0, 1, np.int64(1) << np.maximum(piece - 1, 0))
    low = np.where(piece == 0, 0, width)
    seed = mix(key[p] + (piece.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    time, drawn = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    rate = width * 1.0
    while len(owner):
        # About 5 m points a document at first, so that few rounds are needed.
        live = np.bincount(owner, minlength=n_docs)
        each = np.maximum(1, -(-5 * m // np.maximum(live, 1)))[owner]
        idx = np.repeat(np.arange(len(owner)), each)
        ends = np.cumsum(each)
        j = np.arange(len(idx)) - np.repeat(ends - each, each) + drawn[idx]
        point = mix(seed[idx] + (j.astype(np.uint64) + np.uint64(1)) * _GOLD)
        u = ((point >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        gap = np.rint(np.log(u) * (-_TICKS) / rate[idx]).astype(np.int64)
        total = np.cumsum(gap)
        base = np.where(ends - each > 0, total[np.maximum(ends - each - 1, 0)], 0)
        t = total - base[idx] + time[idx]
        more = mix(point ^ np.uint64(0xA0761D6478BD642F))
        slot = owner[idx] * m + (more % np.uint64(m)).astype(np.int64)
        wide = width[idx]
        level = low[idx] + 1 + ((more >> np.uint64(32)) % wide.astype(np.uint64)).astype(np.int64)
        counts = level <= weight[idx]
        slot, t_in, point = slot[counts], t[counts], point[counts]
        np.minimum.at(best, slot, t_in)
        won = best[slot] == t_in
        sig[slot[won]] = point[won]
        latest = best.reshape(n_docs, m).max(axis=1)
        time, drawn = t[ends - 1], drawn + each
        go = time < latest[owner]
        owner, weight, width, low, seed, time, drawn, rate = (
            v[go] for v in (owner, weight, width, low, seed, time, drawn, rate))
    return sig.reshape(n_docs, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::rows][:, :bands])
    return mix(out + np.arange(bands, dtype=np.uint64) * _GOLD)


def node_keys(doc: np.ndarray, key: np.ndarray, count: np.ndarray, n_docs: int) -> np.ndarray:
    """A hash of each document's whole multiset."""
    total = np.zeros(n_docs, np.uint64)
    np.add.at(total, doc, mix(key + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return mix(total)


def _elements(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The multiset as a set: a hash of each shingle and number of its copy."""
    copy = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return mix(np.repeat(key, count) + copy.astype(np.uint64) * _GOLD)


def _sketch_rows(bands: int, rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column(2), CHUNK):
            doc, key, count = multisets(Words(data, offsets))
            n = b - a
            size = np.bincount(doc, count, n).astype(np.int64)
            node = node_keys(doc, key, count, n)
            hashes = band_hashes(signatures(doc, key, count, n, bands * rows), bands, rows)
            have = size > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(have, bands, 0))]).astype(np.int32)),
                pa.array(hashes[have].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(node.view(np.int64), mask=~have), pa.array(size), lists],
                names=["id", "h", "node", "size", "bands"])


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in chunks(batch.column(1), CHUNK):
            doc, key, count = multisets(Words(data, offsets))
            node = node_keys(doc, key, count, b - a).view(np.int64)
            size = np.bincount(doc, count, b - a).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                             pa.array(_elements(key, count).view(np.int64)))
            out = pa.RecordBatch.from_arrays([pa.array(node), lists], names=["node", "elements"])
            yield out.filter(pa.array(node == wanted[a:b]))


def _classes(df: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, rows: int) -> DataFrame:
    """A written row per row of ``df``: id, h (hash of the text), class_id,
    class_size, kept."""
    find_package(df.sparkSession)
    base = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("t")).withColumn("h", F.xxhash64("t"))
    sketch = written(base.select("id", "h", "t").mapInArrow(lambda it: tidied(_sketch_rows(bands, rows, it)),
                                                            "id bigint, h bigint, node bigint, size bigint, bands array<bigint>")
                     .withColumn("row", F.monotonically_increasing_id()), "sketch")
    # A node's text is found again by identifier and text hash: rows without identifier differ by the latter.
    nodes = written(sketch.filter("node IS NOT NULL").groupBy("node")
                    .agg(F.min(F.struct("h", "id")).alias("of"), F.max("size").alias("size"), F.first("bands").alias("bands")), "nodes")

    # Buckets of at least two nodes.  Their leader is the member that shares
    # most buckets with most nodes: the hub of a group of near copies.
    entries = nodes.select("node", "size", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = written(entries.join(shared, "bucket"), "entries")
    score = written(entries.groupBy("node").agg(F.sum("n").alias("score")), "scores")
    leaders = (entries.join(score, "node").groupBy("bucket")
               .agg(F.max(F.struct("score", "node"))["node"].alias("leader")))
    entries = written(entries.drop("n").join(written(leaders, "leaders"), "bucket"), "entries")
    sizes = nodes.select(F.col("node").alias("leader"), F.col("size").alias("leader_size"))
    fits = F.least("size", "leader_size") >= F.lit(similarity) * F.greatest("size", "leader_size")
    stars = entries.filter("node != leader").select("leader", "node", "size").distinct()

    # The multisets of all nodes that share a bucket.
    members = entries.select("node").distinct().join(nodes.select("node", F.col("of.h").alias("nh"), F.col("of.id").alias("nid")), "node")
    texts = base.join(members, (base["h"] == members["nh"]) & base["id"].eqNullSafe(members["nid"])).select("node", "t")
    sets = written(texts.mapInArrow(lambda it: tidied(_element_rows(it)), "node bigint, elements array<bigint>")
                   .dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """pairs (a, b) with their similarity."""
        one = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
        two = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
        both = pairs.join(one, "b").join(two, "a").select(
            "a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("total"))
        return both.select("a", "b", (F.col("common") / (F.col("total") - F.col("common"))).alias("s"))

    near = stars.join(sizes, "leader").filter(fits).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    star_links = written(verified(near), "star-links")
    roots = components(star_links.filter(F.col("s") >= similarity))

    # What the leaders leave open.
    entries = (entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
               .join(star_links.select(F.col("a").alias("leader"), F.col("b").alias("node"), "s"),
                     ["leader", "node"], "left")
               # Too different in size from the leader: no exact distance, only a bound.
               .withColumn("exact", F.col("s").isNotNull() | (F.col("node") == F.col("leader")))
               .withColumn("d", F.when(F.col("node") == F.col("leader"), 0.0).otherwise(1 - F.col("s"))))
    mixed = (entries.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
             .filter("r0 != r1").select("bucket"))
    open_ = written(entries.join(mixed, "bucket").select("bucket", "band", "node", "size", "root", "d", "leader"), "open")
    tops = open_.filter("node = leader").select("bucket", F.col("root").alias("top"))
    open_ = open_.join(tops, "bucket")
    # Members of the leader's component are only needed as near to the rim as
    # the nearest outsider asks for.
    near_rim = (open_.filter("root != top").groupBy("bucket")
                .agg(F.min(F.coalesce("d", F.lit(0.0))).alias("rim")))
    gap = F.lit(1 - similarity)
    open_ = (open_.join(near_rim, "bucket")
             .filter((F.col("root") != F.col("top")) | F.col("d").isNull() | (F.col("d") >= F.col("rim") - gap)))
    # The leader itself is compared with everything already.
    open_ = written(open_.filter("node != leader").select("bucket", "band", "node", "size", "root", "d", "leader"), "open")
    # What each open node shares with its leaders, and what it lacks of them.
    one = sets.select("node", F.col("elements").alias("y"))
    two = sets.select(F.col("node").alias("leader"), F.col("elements").alias("x"))
    measured = (open_.select("leader", "node").distinct().join(one, "node").join(two, "leader")
                .select("leader", "node", F.size("x").alias("leader_size"), F.array_except("x", "y").alias("lacks")))
    # Elements that no other open node or leader has are in no overlap.
    known = open_.select("node").unionByName(open_.select(F.col("leader").alias("node"))).distinct()
    own = (sets.join(known, "node", "left_semi").select("node", F.explode("elements").alias("e"))
           .groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
           .filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    left = (open_.join(measured, ["leader", "node"]).join(written(own, "own"), "node", "left")
            .withColumn("v", F.col("size") - F.coalesce("own", F.lit(0))).drop("own")
            .filter(F.col("v") >= F.lit(similarity) * F.col("size") - 1e-9)
            # Elements outside the leader that some other text has too.
            .withColumn("more", F.col("v") - (F.col("leader_size") - F.size("lacks")))
            .join(nodes.select("node", "bands"), "node"))
    left = written(left, "left")
    x, y = left.alias("x"), left.alias("y")
    need = F.lit(similarity / (1 + similarity)) * (F.col("x.size") + F.col("y.size")) - 1e-9
    # Two texts share, of the leader, what neither lacks, and beyond it what
    # the one with less there can share.
    most = (F.col("x.leader_size") - F.size(F.array_union("x.lacks", "y.lacks")) + F.least("x.more", "y.more"))
    # A pair comes from the first band that it shares, once.
    first_band = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) - 1
    rest = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") < F.col("y.root"))
                   & (F.least("x.v", "y.v") >= need)
                   & (F.coalesce(F.abs(F.col("x.d") - F.col("y.d")), F.lit(0.0)) <= gap + 1e-9)
                   & (first_band == F.col("x.band")) & (most >= need))
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    rest_links = written(verified(rest).filter(F.col("s") >= similarity), "rest-links")
    links = (star_links.filter(F.col("s") >= similarity).select("a", "b")
             .unionByName(rest_links.select("a", "b")))
    final = roots if rest_links.isEmpty() else components(links)

    classed = (sketch.select("id", "h", "row", "node").join(final, "node", "left")
               .withColumn("class", F.coalesce("root", "node")).select("id", "h", "row", "class"))
    classed = written(classed, "classed")
    # One row of a class stays: of the least identifier (none counts as the greatest), the first such row.
    least = (classed.filter("class IS NOT NULL").groupBy("class")
             .agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                  F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("stays")))
    out = classed.join(written(least, "classes"), "class", "left")
    alone = F.col("class").isNull()
    return out.select("id", "h", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
                      (alone | (F.col("row") == F.col("stays"))).alias("kept"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id (least identifier of the
    class), class_size and kept (one row of the class, of the least identifier)."""
    out = _classes(df, id_col, text_col, similarity, bands, rows)
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
              bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` without all but one row of each class.  Rows are known by
    identifier (or none) and text; of rows with both equal one stays."""
    classed = _classes(docs, id_col, text_col, similarity, bands, rows)
    by_key = written(classed.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("kept")).alias("gone")).filter("gone > 0")
                     .select(F.col("id").alias("__id"), F.col("h").alias("__h"), (F.col("gone") < F.col("n")).alias("__some")), "near-gone")
    ident, h = F.col(f"`{id_col}`").cast("bigint"), F.xxhash64(f"`{text_col}`")
    gone = by_key.filter("NOT __some")
    out = docs.join(gone, ident.eqNullSafe(gone["__id"]) & (h == gone["__h"]), "left_anti")
    twins = by_key.filter("__some")
    if twins.isEmpty():
        return out
    # Of the rows given more than once and not gone altogether, one each.
    same = ident.eqNullSafe(twins["__id"]) & (h == twins["__h"])
    name = spare_name(docs.columns, "__h")
    once = docs.join(twins, same, "left_semi").withColumn(name, h).dropDuplicates([id_col, name]).drop(name)
    return out.join(twins, same, "left_anti").unionByName(once)
