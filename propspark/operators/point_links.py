"""J9 without its list of pairs: which points of one name lie within a
threshold of each other, told by classes.

Points at one coordinate are a site.  Sites fall into cells of side
``CELL * threshold``, so all points of a cell (a class) are linked to each
other and no pair of them is written.  Two cells at most two steps apart are
compared by the boxes around their sites: if the farthest corners are within
the threshold, one row links all of the one with all of the other; if the
nearest sides are not, nothing links them; else both are halved along each
axis and their quarters are compared likewise, ``levels`` times in all.  What
is undecided then is compared site by site, so explicit pairs remain only
where the circle of one cell cuts through a small cell of another.

A box around one site is the site itself, so sparse cells are settled at the
first level.  Sites and cells are combining aggregates: a name or a coordinate
that holds a third of all points is reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propspark.constants import POI_DEDUP_THRESHOLD_M
from propspark.functions.geo import euclidean
from propspark.session import reliable_checkpoint

#: Side of a cell in thresholds: a little below 1 / sqrt(2), so that the
#: corners of a cell are within the threshold of each other.
CELL = 0.7071
LEVELS = 4
#: The half of the 5 x 5 neighbour cells that meets each pair once.
_STEPS = [(dx, dy) for dx in range(3) for dy in range(-2, 3) if dx > 0 or dy > 0]
_BOX = ["fx", "fy", "n", "first", "x0", "x1", "y0", "y1"]
_LINK = ["level", "nm", "a_fx", "a_fy", "b_fx", "b_fy", "a", "b", "n_a", "n_b"]


def _sites(poi: DataFrame, name: str, order: str, x: str, y: str) -> DataFrame:
    """One row per name and coordinate: its number of points and first order.
    Points without name or finite coordinates are linked to none."""
    finite = (F.abs(F.col("px")) < float("inf")) & (F.abs(F.col("py")) < float("inf"))
    points = poi.select(F.col(name).alias("nm"), F.col(order).alias("o"), F.col(x).cast("double").alias("px"),
                        F.col(y).cast("double").alias("py"))
    return (points.filter(finite & F.col("nm").isNotNull()).groupBy("nm", "px", "py")
            .agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("first")))


def _cell(side: float) -> list[Column]:
    return [F.floor(F.col("px") / side).alias("fx"), F.floor(F.col("py") / side).alias("fy")]


def _boxes(sites: DataFrame, side: float) -> DataFrame:
    return (sites.groupBy("nm", *_cell(side))
            .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.min("px").alias("x0"), F.max("px").alias("x1"),
                 F.min("py").alias("y0"), F.max("py").alias("y1")))


def _end(rows: DataFrame, p: str) -> DataFrame:
    return rows.select("nm", *[F.col(c).alias(p + c) for c in rows.columns if c != "nm"])


def _quarters(undecided: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pairs of the quarters of undecided pairs."""
    pairs = undecided.select("nm", *[F.col(p + c).alias(f"up_{p}{c}") for p in ("a_", "b_") for c in ("fx", "fy")])
    for p in ("a_", "b_"):
        # Halving a side doubles the quotient exactly.
        end = (_end(boxes, p).withColumn(f"up_{p}fx", F.shiftright(p + "fx", 1))
               .withColumn(f"up_{p}fy", F.shiftright(p + "fy", 1)))
        pairs = pairs.join(end, ["nm", f"up_{p}fx", f"up_{p}fy"])
    return pairs


def _judged(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs of boxes that may be linked, and whether they are as a whole."""
    def far(c: str) -> Column:
        return F.greatest(F.abs(F.col(f"a_{c}1") - F.col(f"b_{c}0")), F.abs(F.col(f"b_{c}1") - F.col(f"a_{c}0")))

    def gap(c: str) -> Column:
        return F.greatest(F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.lit(0.0))

    def length(dx: Column, dy: Column) -> Column:
        return F.sqrt(dx * dx + dy * dy)

    ends = [p + c for p in ("a_", "b_") for c in ("fx", "fy", "n", "first")]
    return (pairs.filter(length(gap("x"), gap("y")) <= threshold)
            .select("nm", *ends, (length(far("x"), far("y")) <= threshold).alias("whole")))


def same_name_links(poi: DataFrame, threshold: float = POI_DEDUP_THRESHOLD_M, name: str = "name", order: str = "ord",
                    x: str = "x_proj", y: str = "y_proj", levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(members, links).

    members: one row per point: ``order``, class_id (the least order of its
    class; its own for a point without name or place) and n_links (points of
    the same name within ``threshold``, inclusive).

    links: level, nm, cells a_fx, a_fy, b_fx, b_fy of that level, their least
    orders a and b and numbers of points n_a and n_b: every point of the one
    is within the threshold of every point of the other.  At level ``levels``
    (cells null) a and b are single sites.  Pairs inside a class are implied.

    ``order`` must be unique.  An empty table gives empty results.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    sites = reliable_checkpoint(_sites(poi, name, order, x, y))
    sides = [CELL * threshold / (1 << level) for level in range(levels)]
    first_boxes = reliable_checkpoint(_boxes(sites, sides[0]))

    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _STEPS])
    near = (_end(first_boxes, "a_").withColumn("s", F.explode(steps))
            .withColumn("b_fx", F.col("a_fx") + F.col("s.dx")).withColumn("b_fy", F.col("a_fy") + F.col("s.dy")))
    pairs = near.join(_end(first_boxes, "b_"), ["nm", "b_fx", "b_fy"])
    found = []
    for level in range(levels):
        judged = reliable_checkpoint(_judged(pairs, threshold))
        found.append(judged.filter("whole").select(
            F.lit(level).alias("level"), "nm", "a_fx", "a_fy", "b_fx", "b_fy", F.col("a_first").alias("a"),
            F.col("b_first").alias("b"), F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b")))
        undecided = judged.filter("NOT whole")
        if undecided.isEmpty():
            break
        if level < levels - 1:
            pairs = _quarters(undecided, _boxes(sites, sides[level + 1]))
    else:
        placed = sites.select("nm", "px", "py", "n", "first", *_cell(sides[-1]))
        cells = undecided.select("nm", "a_fx", "a_fy", "b_fx", "b_fy")
        for p in ("a_", "b_"):
            cells = cells.join(_end(placed, p), ["nm", p + "fx", p + "fy"])
        none = F.lit(None).cast("bigint")
        found.append(reliable_checkpoint(
            cells.filter(euclidean("a_px", "a_py", "b_px", "b_py") <= threshold)
            .select(F.lit(levels).alias("level"), "nm", *[none.alias(c) for c in _LINK[2:6]], F.col("a_first").alias("a"),
                    F.col("b_first").alias("b"), F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b"))))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return _members(poi, sites, first_boxes, links, sides, (name, order, x, y)), links


def _members(poi: DataFrame, sites: DataFrame, first_boxes: DataFrame, links: DataFrame, sides: list[float],
             columns: tuple[str, str, str, str]) -> DataFrame:
    name, order, x, y = columns
    both = links.select("level", "nm", F.col("a_fx").alias("fx"), F.col("a_fy").alias("fy"), F.col("a").alias("first"),
                        F.col("n_b").alias("more")).unionByName(
        links.select("level", "nm", F.col("b_fx").alias("fx"), F.col("b_fy").alias("fy"), F.col("b").alias("first"),
                     F.col("n_a").alias("more")))
    by_cell = (both.filter(F.col("level") < len(sides)).groupBy("nm", "level", "fx", "fy").agg(F.sum("more").alias("more")))
    by_site = both.filter(F.col("level") == len(sides)).groupBy("first").agg(F.sum("more").alias("alone"))
    classes = first_boxes.select("nm", "fx", "fy", F.lit(0).alias("level"), F.col("first").alias("class_id"),
                                 (F.col("n") - 1).alias("inside"))
    levels = F.array(*[F.struct(F.lit(level).alias("level"), *_cell(side)) for level, side in enumerate(sides)])
    cells = sites.select("nm", "px", "py", "first", F.inline(levels))
    key = ["nm", "level", "fx", "fy"]
    counted = (cells.join(by_cell, key, "left").join(classes, key, "left").groupBy("first")
               .agg(F.first("nm").alias("nm"), F.first("px").alias("px"), F.first("py").alias("py"),
                    F.max("class_id").alias("class_id"),
                    (F.coalesce(F.sum("more"), F.lit(0)) + F.max("inside")).alias("n_links")))
    counted = counted.join(by_site, "first", "left").select(
        "nm", "px", "py", "class_id", (F.col("n_links") + F.coalesce(F.col("alone"), F.lit(0))).alias("n_links"))
    points = poi.select(F.col(order), F.col(name).alias("nm"), F.col(x).cast("double").alias("px"),
                        F.col(y).cast("double").alias("py"))
    # One row per coordinate on the right: a coordinate with very many points is split by AQE's skew join.
    return points.join(counted, ["nm", "px", "py"], "left").select(
        order, F.coalesce("class_id", F.col(order)).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
