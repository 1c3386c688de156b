"""Radius joins and POI dedup on planar (Lambert-93) coordinates.

Radius join (J7, J8, A20, G5) as a grid-cell equi join:

* each point is tagged once per category with the cell
  ``(floor(x / r), floor(y / r))`` of that category's radius ``r``;
* each POI is exploded to the 3 x 3 block of cells around its own cell, so
  every POI within ``r`` of a point shares a key ``(category, cx, cy)`` with
  it (a point and a POI closer than r are at most one cell apart);
* the equi join carries the exact test ``distance <= r`` as a join
  condition, and the result is aggregated per point straight away (partial
  aggregation map-side), so neighbour lists are never collected.

The POI side is broadcast only when its estimated size passes a check;
otherwise the join is a shuffle join, before which the points are counted by
cell: a dense cell (a city centre, a 30 km airport cell) is split into as many
parts as its points need and its POIs are repeated for each, while the POIs of
all other cells go to their nine cells once.

Features depend on coordinates only (J18): the join runs on the distinct
coordinates of the sales and the result is joined back on them.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import POI_CATEGORIES, POI_DEDUP_THRESHOLD_M, POI_RADIUS_M
from propspark.functions.geo import euclidean, lambert93_x, lambert93_y
from propspark.operators.joins import is_small, salted_join
from propspark.session import reliable_checkpoint

NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
DEFAULT_POI_BROADCAST_BYTES = 256 * 1024 * 1024


def project(df: DataFrame, lon: str = "longitude", lat: str = "latitude",
            x: str = "x_proj", y: str = "y_proj") -> DataFrame:
    """G1: add Lambert-93 metres."""
    return df.withColumns({x: lambert93_x(lon, lat), y: lambert93_y(lon, lat)})


def _category_array(categories, radii):
    return F.array(*[F.struct(F.lit(c).alias("category"), F.lit(float(radii[c])).alias("radius"))
                     for c in categories])


def _poi_cells(poi: DataFrame, categories, radii, x: str, y: str) -> DataFrame:
    rad = F.create_map(*[v for c in categories for v in (F.lit(c), F.lit(float(radii[c])))])
    blk = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in NEIGHBOURS])
    return (poi.filter(F.col("category").isin(list(categories)))
            .select("category", F.col("id").alias("poi_id"),
                    F.col(x).alias("px"), F.col(y).alias("py"))
            .withColumn("_r", F.element_at(rad, F.col("category")))
            .withColumn("_b", F.explode(blk))
            .select("category", "poi_id", "px", "py",
                    (F.floor(F.col("px") / F.col("_r")) + F.col("_b.dx")).alias("cx"),
                    (F.floor(F.col("py") / F.col("_r")) + F.col("_b.dy")).alias("cy")))


#: Rows of points in one grid cell beyond which the cell is split.
CELL_POINTS = 200_000
#: Split cells that are broadcast at most (each stands for CELL_POINTS rows).
DENSE_CELLS = 200_000


def _by_category(points: DataFrame, keys: list[str], categories, radii, x: str, y: str) -> DataFrame:
    """A row per point and category: keys, qx, qy, category, radius."""
    return (points.select(*keys, F.col(x).alias("qx"), F.col(y).alias("qy"))
            .withColumn("_c", F.explode(_category_array(categories, radii)))
            .select(*keys, "qx", "qy", F.col("_c.category").alias("category"), F.col("_c.radius").alias("radius")))


def _dense_cells(pts: DataFrame, cell_points: int) -> DataFrame:
    """Cells with more than ``cell_points`` rows and the parts they need: at
    most one row per ``cell_points`` rows of ``pts``."""
    dense = reliable_checkpoint(pts.groupBy("category", "cx", "cy").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_points)
                                .select("category", "cx", "cy", F.ceil(F.col("n") / F.lit(cell_points)).cast("int").alias("_parts")))
    return F.broadcast(dense) if dense.count() <= DENSE_CELLS else dense


def _cell_pairs(pts: DataFrame, poi: DataFrame, keys: list[str], categories, radii, x: str, y: str, how: str,
                broadcast_bytes: int, salt_buckets: int, cell_points: int) -> DataFrame:
    """Pairs of ``_by_category`` rows and the POIs of their category within
    the radius."""
    pts = (pts.withColumn("cx", F.floor(F.col("qx") / F.col("radius")))
           .withColumn("cy", F.floor(F.col("qy") / F.col("radius"))))
    cells = _poi_cells(poi, categories, radii, x, y)
    on = ["category", "cx", "cy"]
    # The estimate of an explode keeps its input's size: check the POI
    # columns before the 9-fold neighbour explode against a 9-fold smaller limit.
    poi_cols = poi.select("category", "id", x, y)
    if is_small(poi_cols, broadcast_bytes // len(NEIGHBOURS)):
        left, right = pts, F.broadcast(cells)
    else:
        # Counted first: only a dense cell is split, and only its POIs are repeated.
        dense = _dense_cells(pts, cell_points)
        parts = F.greatest(F.coalesce("_parts", F.lit(1)), F.lit(salt_buckets))
        left = (pts.join(dense, on, "left")
                .withColumn("_salt", F.pmod(F.xxhash64(*keys, "qx", "qy"), parts).cast("int")).drop("_parts"))
        right = (cells.join(dense, on, "left")
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
        on = on + ["_salt"]
    dist = euclidean("qx", "qy", "px", "py")
    cond = [left[k] == right[k] for k in on] + [dist <= left["radius"]]
    joined = left.join(right, cond, how)
    return joined.select(*[left[k] for k in keys], left["category"], right["poi_id"],
                         F.when(right["poi_id"].isNotNull(), dist).alias("dist"))


def radius_pairs(points: DataFrame, poi: DataFrame, keys: list[str],
                 categories=POI_CATEGORIES, radii=POI_RADIUS_M,
                 x: str = "x_proj", y: str = "y_proj", how: str = "left",
                 broadcast_bytes: int = DEFAULT_POI_BROADCAST_BYTES,
                 salt_buckets: int = 1, cell_points: int = CELL_POINTS) -> DataFrame:
    """(point keys, category, poi_id, dist) for every POI within its radius.

    ``how="left"`` keeps one row with NULL poi for a point/category without
    match.  ``points`` must be unique on ``keys``; ``poi`` has columns
    ``category, id`` and the ``x``/``y`` metres.  POIs too many to broadcast
    are shuffled by cell; the points are then counted by cell (they are
    checkpointed for that), and a cell with more than ``cell_points`` of them
    is split into as many parts as it needs, at least ``salt_buckets``.
    """
    if not is_small(poi.select("category", "id", x, y), broadcast_bytes // len(NEIGHBOURS)):
        points = reliable_checkpoint(points.select(*keys, x, y))
    pts = _by_category(points, keys, categories, radii, x, y)
    return _cell_pairs(pts, poi, keys, categories, radii, x, y, how, broadcast_bytes, salt_buckets, cell_points)


def radius_features(points: DataFrame, poi: DataFrame, keys: list[str],
                    categories=POI_CATEGORIES, radii=POI_RADIUS_M,
                    x: str = "x_proj", y: str = "y_proj", **kw) -> DataFrame:
    """Per point ``nb_<cat>`` (INT, 0 when none) and ``distance_min_<cat>``
    (nearest distance rounded half-even to 2 decimals, NULL when none)."""
    pairs = radius_pairs(points, poi, keys, categories, radii, x, y, how="left", **kw)
    aggs = []
    for c in categories:
        hit = (F.col("category") == c) & F.col("poi_id").isNotNull()
        aggs.append(F.count_if(hit).cast("int").alias(f"nb_{c}"))
        aggs.append(F.bround(F.min(F.when(hit, F.col("dist"))), 2).alias(f"distance_min_{c}"))
    return pairs.groupBy(*keys).agg(*aggs)


#: Radii at which the nearest POI is looked for, as parts of the full one.
NEAREST_STEPS = (1 / 16, 1 / 4, 1.0)


def nearest_poi(points: DataFrame, poi: DataFrame, keys: list[str],
                categories=POI_CATEGORIES, radii=POI_RADIUS_M,
                x: str = "x_proj", y: str = "y_proj", steps=NEAREST_STEPS,
                broadcast_bytes: int = DEFAULT_POI_BROADCAST_BYTES,
                salt_buckets: int = 1, cell_points: int = CELL_POINTS) -> DataFrame:
    """Per point and category the nearest POI within the radius
    (ties broken by the smaller POI id), as an aggregation, no window.

    The search expands over a pyramid of grids: with cells of a sixteenth of
    the radius first, then of a quarter, then of all of it.  A point and
    category with a POI within a step's radius is settled there (all POIs so
    near were compared) and does not take part in the wider ones, so a point
    amid many POIs never meets all those of the full radius."""
    open_ = reliable_checkpoint(_by_category(points, keys, categories, radii, x, y))
    found = []
    for step in steps:
        near = {c: float(radii[c]) * step for c in categories}
        pts = open_.withColumn("radius", F.col("radius") * F.lit(step))
        pairs = _cell_pairs(pts, poi, keys, categories, near, x, y, "inner", broadcast_bytes, salt_buckets, cell_points)
        best = pairs.groupBy(*keys, "category").agg(F.min(F.struct("dist", "poi_id")).alias("b"))
        if step == steps[-1]:
            found.append(best)
            break
        best = reliable_checkpoint(best)
        found.append(best)
        done = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "category"])])
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "category"])]
        open_ = reliable_checkpoint(open_.join(done, same, "left_anti"))
    best = reduce(DataFrame.unionByName, found)
    return best.select(*keys, "category", F.col("b.poi_id").alias("poi_id"), F.col("b.dist").alias("dist"))


def features_by_coordinates(sales: DataFrame, poi: DataFrame,
                            lon: str = "longitude", lat: str = "latitude",
                            categories=POI_CATEGORIES, radii=POI_RADIUS_M,
                            join_back_salt: int = 1, **kw) -> DataFrame:
    """Sales + radius features, computed once per distinct coordinate
    pair and joined back on the coordinates (no positional zip).

    The join back is many-to-one on ``(lon, lat)``.  A coordinate shared by a
    large share of the sales is split by AQE's skew-join handling (the
    feature side holds one row per key); ``join_back_salt > 1`` salts it
    explicitly instead (the feature side is replicated once per salt).
    """
    coords = project(sales.select(lon, lat).filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
                     .distinct(), lon, lat)
    feats = radius_features(coords, poi, [lon, lat], categories, radii, **kw)
    return salted_join(sales, feats, [lon, lat], "left", buckets=join_back_salt)


# ------------------------------------------------------------------ POI dedup
def same_name_edges(poi: DataFrame, threshold: float = POI_DEDUP_THRESHOLD_M,
                    name: str = "name", order: str = "ord",
                    x: str = "x_proj", y: str = "y_proj") -> DataFrame:
    """Edges (a, b) with equal name, b earlier than a, distance <= threshold.

    Keyed by ``(name, cell)``: even the group of unnamed POIs is split by
    cell, so no group is paired all-against-all.
    """
    blk = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in NEIGHBOURS])
    base = poi.select(F.col(name).alias("nm"), F.col(order).alias("o"),
                      F.col(x).alias("px"), F.col(y).alias("py"),
                      F.floor(F.col(x) / threshold).alias("cx"), F.floor(F.col(y) / threshold).alias("cy"))
    a = base.alias("a")
    b = (base.withColumn("_b", F.explode(blk))
         .select("nm", "o", "px", "py", (F.col("cx") + F.col("_b.dx")).alias("cx"),
                 (F.col("cy") + F.col("_b.dy")).alias("cy")).alias("b"))
    cond = ((F.col("a.nm") == F.col("b.nm")) & (F.col("a.cx") == F.col("b.cx")) &
            (F.col("a.cy") == F.col("b.cy")) & (F.col("b.o") < F.col("a.o")) &
            (euclidean("a.px", "a.py", "b.px", "b.py") <= threshold))
    return a.join(b, cond, "inner").select(F.col("a.o").alias("a"), F.col("b.o").alias("b"))


#: Cells along a side of the blocks in which neighbouring cells are linked.
LINK_BLOCK = 256
#: A group of linked cells with more points is settled in rounds.
FOLD_POINTS = 100_000
#: Points that a task of the fold holds, about.
FOLD_BUCKET_POINTS = 200_000
_REACH = 2


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the component of each of ``n`` nodes with links a-b."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while (root[root] != root).any():
            root = root[root]


def _link_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Cells of one block (fx, fy, comp): which components its neighbouring
    cells join, as (comp, root)."""
    label, comp = np.unique(pdf["comp"].to_numpy(), return_inverse=True)
    fx, fy = pdf["fx"].to_numpy() - pdf["fx"].min(), pdf["fy"].to_numpy() - pdf["fy"].min()
    width = int(fy.max()) + 2 * _REACH + 1
    key = fx * width + fy
    order = np.argsort(key)
    key, comp = key[order], comp[order]
    links = []
    for dx in range(_REACH + 1):
        for dy in range(-_REACH, _REACH + 1):
            if dx or dy > 0:
                at = np.minimum(np.searchsorted(key, key + dx * width + dy), len(key) - 1)
                hit = key[at] == key + dx * width + dy
                links.append((comp[hit], comp[at[hit]]))
    root = _roots(len(label), *(np.concatenate(x) for x in zip(*links)))
    moved = np.flatnonzero(root != np.arange(len(label)))
    return pd.DataFrame({"comp": label[moved], "root": label[root[moved]]})


def linked_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``cells`` (keys, fx, fy, ...) with ``comp``, the number of the group of
    cells that are linked by steps of at most two cells either way.

    Cells are linked block by block, then the blocks' border cells in blocks
    ``LINK_BLOCK`` times as wide, until one block covers the extent: the
    number of passes follows the extent's logarithm (two for a country in
    cells of 18 m), not the length of a chain of cells."""
    spark = cells.sparkSession
    ends = cells.agg(*[fn(c).alias(f"{c}_{fn.__name__}") for c in ("fx", "fy") for fn in (F.min, F.max)]).first()
    out = cells.withColumn("comp", F.xxhash64(*keys, "fx", "fy"))
    if ends["fx_min"] is None:
        return out
    extent = max(ends["fx_max"] - ends["fx_min"], ends["fy_max"] - ends["fy_min"]) + 1
    x, y = F.col("fx") - F.lit(ends["fx_min"]), F.col("fy") - F.lit(ends["fy_min"])
    types = dict(cells.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["comp bigint", "root bigint"])
    span = 1
    while span < extent:
        inner, span = span, span * LINK_BLOCK
        part = out.select(*keys, "fx", "fy", "comp", F.floor(x / span).alias("bx"), F.floor(y / span).alias("by"))
        if inner > 1:  # only cells at the border of the blocks before can link them
            part = part.filter((F.pmod(x, F.lit(inner)) < _REACH) | (F.pmod(x, F.lit(inner)) >= inner - _REACH) |
                               (F.pmod(y, F.lit(inner)) < _REACH) | (F.pmod(y, F.lit(inner)) >= inner - _REACH))

        def link(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            moved = _link_block(pdf)
            for i, k in enumerate(keys):
                moved.insert(i, k, pd.Series([key[i]] * len(moved), dtype=object))
            return moved

        # A block with one cell has nothing to link: it never reaches Python.
        busy = part.groupBy(*keys, "bx", "by").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        moved = reliable_checkpoint(part.join(busy, [*keys, "bx", "by"], "left_semi")
                                    .groupBy(*keys, "bx", "by").applyInPandas(link, schema))
        out = out.join(moved, [*keys, "comp"], "left").withColumn("comp", F.coalesce("root", "comp")).drop("root")
    return out


def _fold(threshold: float, pdf: pd.DataFrame) -> pd.DataFrame:
    """Points of whole groups of cells, scanned in order: a cell holds one
    kept point at most, so 25 cells are looked at for each point."""
    near = [(dx, dy) for dx in range(-_REACH, _REACH + 1) for dy in range(-_REACH, _REACH + 1)]
    kept: dict[tuple, tuple] = {}
    keep = []
    pdf = pdf.sort_values("o", kind="stable")
    for comp, fx, fy, px, py in zip(*(pdf[c].tolist() for c in ("comp", "fx", "fy", "px", "py"))):
        for dx, dy in near:
            k = kept.get((comp, fx + dx, fy + dy))
            if k is not None and math.sqrt((k[0] - px) * (k[0] - px) + (k[1] - py) * (k[1] - py)) <= threshold:
                keep.append(False)
                break
        else:
            kept[comp, fx, fy] = px, py
            keep.append(True)
    return pdf[keep].astype({c: object for c in pdf.columns if not isinstance(pdf[c].dtype, np.dtype)})


def greedy_dedup(poi: DataFrame, threshold: float = POI_DEDUP_THRESHOLD_M,
                 name: str = "name", order: str = "ord",
                 x: str = "x_proj", y: str = "y_proj", max_rounds: int | None = None,
                 small_cell: int = 8, group_cols: list[str] | None = None,
                 fold_points: int = FOLD_POINTS) -> DataFrame:
    """Same result as scanning POIs in ``order`` and keeping a POI unless
    an already kept POI of the same name lies within ``threshold``
    (inclusive); equivalently a POI is kept iff none of its earlier
    same-name neighbours is kept.  ``order`` must be unique.

    POIs are keyed by (name, fine cell) with cell side ``threshold/sqrt(2)``:
    two POIs of one cell are always within the threshold, and conflicts reach
    two cells at most.  Cells of a name that are linked by such steps form
    groups (``linked_cells``), which do not concern each other:

    * a group of one cell keeps its earliest POI: an aggregation;
    * a group of at most ``fold_points`` POIs is scanned in order in one task;
    * only the POIs of larger groups go through rounds (``_in_rounds``), at
      most ``max_rounds`` if given.

    ``group_cols`` (e.g. the POI category) run independent dedups per
    group: POIs of different groups never suppress each other.
    """
    keys = [*(group_cols or []), "nm"]
    side = threshold / math.sqrt(2.0) * (1.0 - 1e-9)
    cell = [*keys, "fx", "fy"]
    points = reliable_checkpoint(poi.select(
        *(group_cols or []), F.col(name).alias("nm"), F.col(order).alias("o"), F.col(x).alias("px"), F.col(y).alias("py"),
        F.floor(F.col(x) / side).alias("fx"), F.floor(F.col(y) / side).alias("fy")))
    cells = reliable_checkpoint(points.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("first")))
    linked = linked_cells(cells, keys)
    groups = linked.groupBy("comp").agg(F.sum("n").alias("points"), F.count(F.lit(1)).alias("cells"))
    linked = reliable_checkpoint(linked.join(groups, "comp"))
    kept = linked.filter("cells = 1").select(*(group_cols or []), F.col("first").alias(order))
    left = linked.filter("cells > 1")
    sizes = left.agg(F.sum(F.when(F.col("points") <= fold_points, F.col("n"))).alias("fold"),
                     F.sum(F.when(F.col("points") > fold_points, F.col("n"))).alias("rest")).first()
    shape = points.withColumn("comp", F.lit(0).cast("bigint"))
    if sizes["fold"]:
        buckets = -(-sizes["fold"] // FOLD_BUCKET_POINTS)
        some = left.filter(F.col("points") <= fold_points).select(*cell, "comp")
        fields = ", ".join(f"`{c}` {t}" for c, t in shape.dtypes)
        folded = (points.join(some, cell).select(*shape.columns).groupBy(F.pmod("comp", F.lit(buckets)).alias("bucket"))
                  .applyInPandas(lambda pdf: _fold(threshold, pdf), fields))
        kept = kept.unionByName(folded.select(*(group_cols or []), F.col("o").alias(order)))
    if sizes["rest"]:
        giants = left.filter(F.col("points") > fold_points).select(*cell)
        rest = _in_rounds(points.join(giants, cell, "left_semi"), threshold, list(group_cols or []), max_rounds, small_cell)
        kept = kept.unionByName(rest.select(*(group_cols or []), F.col("o").alias(order)))
    return poi.join(kept, [*(group_cols or []), order], "left_semi")


def _in_rounds(points: DataFrame, threshold: float, groups: list[str], max_rounds: int | None, small_cell: int) -> DataFrame:
    """Kept points of groups too large for one task.

    * Each round aggregates per cell the earliest undecided order, the
      number of undecided POIs and the kept POI, then per cell over its
      5 x 5 block of neighbour cells: the kept POIs (at most 25), the
      undecided POIs of the neighbour cells that hold at most
      ``small_cell`` of them (at most 24 x ``small_cell``), and the earliest
      undecided order of the larger neighbour cells.  Every collected list
      is bounded.
    * An undecided POI is dropped when a kept, earlier POI of its
      neighbourhood lies within the threshold.  It is kept when it is its
      cell's earliest undecided POI, no earlier undecided POI of a small
      neighbour cell lies within the threshold, no larger neighbour cell
      has an earlier undecided POI at all (a safe, conservative wait), and
      no earlier kept POI lies within the threshold.
      The globally earliest undecided POI is always decided, so every round
      makes progress.
    * State is cut with a reliable checkpoint each round (short lineage,
      survives executor loss).
    """
    blk = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                    for dx in range(-_REACH, _REACH + 1) for dy in range(-_REACH, _REACH + 1)])
    cell = groups + ["nm", "fx", "fy"]
    state = reliable_checkpoint(points.withColumn("s", F.lit("u")))

    def within(p):
        return F.sqrt((p["x"] - F.col("px")) * (p["x"] - F.col("px")) +
                      (p["y"] - F.col("py")) * (p["y"] - F.col("py"))) <= F.lit(threshold)

    rounds, n_parts = 0, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while state.filter(F.col("s") == "u").limit(1).count() > 0:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"greedy_dedup did not converge in {max_rounds} rounds")
        und = state.filter(F.col("s") == "u")
        pt = F.struct(F.col("o").alias("o"), F.col("px").alias("x"), F.col("py").alias("y"))
        is_u = F.col("s") == "u"
        counts = state.groupBy(*cell).agg(F.count_if(is_u).alias("n_u"),
                                          F.min(F.when(is_u, F.col("o"))).alias("first_u"),
                                          F.max(F.when(F.col("s") == "k", pt)).alias("kept"))
        # Undecided points of small cells (at most ``small_cell`` each): a bounded list.
        small_cells = counts.filter((F.col("n_u") > 0) & (F.col("n_u") <= small_cell)).select(*cell)
        small = (und.join(small_cells, cell, "left_semi")
                 .groupBy(*cell).agg(F.collect_list(pt).alias("ulist")))
        per_cell = counts.join(small, cell, "left")
        spread = (per_cell.withColumn("_b", F.explode(blk))
                  .select(*groups, F.col("nm"), (F.col("fx") + F.col("_b.dx")).alias("fx"),
                          (F.col("fy") + F.col("_b.dy")).alias("fy"),
                          ((F.col("_b.dx") == 0) & (F.col("_b.dy") == 0)).alias("self"),
                          "n_u", "first_u", "ulist", "kept"))
        big = ~F.col("self") & (F.col("n_u") > small_cell)
        hood = spread.groupBy(*cell).agg(
            F.max(F.when(F.col("self"), F.col("first_u"))).alias("own_first_u"),
            F.min(F.when(big, F.col("first_u"))).alias("big_first_u"),
            F.flatten(F.collect_list(F.when(~F.col("self"), F.col("ulist")))).alias("nbr_und"),
            F.collect_list("kept").alias("kept_list"))
        cand = und.join(hood, cell, "left")
        near_kept = F.exists("kept_list", lambda k: (k["o"] < F.col("o")) & within(k))
        waits_small = F.exists(F.coalesce(F.col("nbr_und"), F.array()),
                               lambda w: (w["o"] < F.col("o")) & within(w))
        first = ((F.col("own_first_u") == F.col("o")) & ~waits_small &
                 (F.col("big_first_u").isNull() | (F.col("big_first_u") > F.col("o"))))
        decided = cand.select(*cell, "o", "px", "py",
                              F.when(near_kept, F.lit("d")).when(first, F.lit("k")).otherwise(F.lit("u")).alias("s"))
        # Dropped points leave the state; the number of partitions stays the same.
        state = reliable_checkpoint(state.filter(F.col("s") == "k").unionByName(decided.filter(F.col("s") != "d"))
                                    .repartition(n_parts, *cell))
    return state.filter(F.col("s") == "k")


KIND_ORDER = {"node": 0, "way": 1, "area": 2}


def dedup_pois(poi: DataFrame, threshold: float = POI_DEDUP_THRESHOLD_M) -> DataFrame:
    """G4 per category on extracted POIs (``category, kind, id, name,
    x_proj, y_proj``), scanning in the fixed order (kind, id) (quirk Q9), so
    a closed way that also arrives as an area with the same name and place
    is removed (quirk Q8)."""
    kind_idx = F.element_at(F.create_map(*[F.lit(v) for kv in KIND_ORDER.items() for v in kv]), F.col("kind"))
    ordered = poi.withColumn("ord", kind_idx.cast("long") * F.lit(1 << 42) + F.col("id"))
    return greedy_dedup(ordered, threshold, group_cols=["category"]).drop("ord")
