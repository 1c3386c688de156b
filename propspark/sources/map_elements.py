"""Map elements -> points of interest.

The binary map file is landed as a table of elements
``kind STRING (node|way|area), id LONG, tags MAP<STRING,STRING>,
coords ARRAY<STRUCT<lon DOUBLE, lat DOUBLE>>`` (one Parquet dataset, or one
per kind, unioned by name).  Extraction is one narrow pass: tag rules are a
fixed array of ``when`` expressions, geometry is projected and reduced to a
representative point with higher-order array functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import POI_TAG_RULES
from propspark.functions.geo import (lambert93_x, lambert93_y, line_centroid_from_sums, line_sums,
                                     ring_centroid_from_sums, ring_sums, with_ring_validity)
from propspark.functions.scalar import name_or_empty


def union_elements(frames: list[DataFrame]) -> DataFrame:
    """Nodes, ways and areas in one element set."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rule_condition(tags, rule: dict) -> F.Column:
    """A category matches when any of its tag keys has an allowed value
    (``True`` allows any value of that key)."""
    conds = []
    for key, allowed in rule.items():
        v = F.try_element_at(tags, F.lit(key))
        conds.append(v.isNotNull() if allowed is True else v.isin(list(allowed)))
    return reduce(lambda a, b: a | b, conds)


def match_categories(df: DataFrame, rules: dict = POI_TAG_RULES, tags: str = "tags",
                     keep: F.Column | None = None) -> DataFrame:
    """One row per (element, matching category); an element may match
    several categories, at most once each.  Rows where ``keep`` is false
    produce no row (the test rides inside the explode)."""
    cats = F.array_compact(F.array(*[F.when(rule_condition(F.col(tags), r), F.lit(c))
                                     for c, r in rules.items()]))
    if keep is not None:
        cats = F.when(keep, cats)
    return df.withColumn("category", F.explode(cats))


def _located(p):
    return (p["lon"].isNotNull() & p["lat"].isNotNull() & (F.abs(p["lon"]) <= 180) & (F.abs(p["lat"]) <= 90))


def _projected(coords):
    return F.transform(coords, lambda p: F.struct(lambert93_x(p["lon"], p["lat"]).alias("x"),
                                                  lambert93_y(p["lon"], p["lat"]).alias("y")))


def with_representative_point(df: DataFrame, kind: str = "kind", pts: str = "_pts", out: str = "pt",
                              closed: str | None = None, valid: str | None = None) -> DataFrame:
    """G2 on projected points (column ``pts``): node -> the point; way ->
    polygon centroid for >= 3 points, line centroid for 2 points, for a ring
    without area (out and back, or straight) and where ``closed`` (a boolean
    column) says that the way is not to be closed, none below 2; area ->
    centroid of the outer ring when it has >= 3 points, an area and is
    ``valid`` (a boolean column)."""
    p = F.col(pts)
    n = F.size(p)
    first = F.try_element_at(p, F.lit(1))
    step = (df.withColumn("_ring", ring_sums(p)).withColumn("_line", line_sums(p)))
    k = F.col(kind)
    # Area against the square of the length: rounding leaves flat rings a trace of area.
    length = F.col("_line.s.L")
    flat = F.coalesce(F.abs(F.col("_ring.s.a2")) <= 1e-9 * length * length, F.lit(True))
    ring = F.lit(True) if closed is None else F.col(closed)
    whole = F.lit(True) if valid is None else F.col(valid)
    rep = (F.when((k == "node") & (n >= 1), F.struct(first["x"].alias("x"), first["y"].alias("y")))
           .when((k == "way") & (n >= 3) & ~flat & ring, ring_centroid_from_sums(F.col("_ring")))
           .when((k == "way") & (n >= 2), line_centroid_from_sums(F.col("_line")))
           .when((k == "area") & (n >= 3) & ~flat & whole, ring_centroid_from_sums(F.col("_ring"))))
    return step.withColumn(out, rep).drop("_ring", "_line")


def extract_poi(elements, rules: dict = POI_TAG_RULES, close_open_ways: bool = True) -> DataFrame:
    """S10 + P11 + G2 + F24: elements -> (category, kind, id, name, x_proj, y_proj).

    Elements are first reduced to those matching any rule, then each gets
    its representative point once (projected coordinates, validity and
    centroid sums are materialised as columns so no array is re-projected),
    and only then is it exploded to one row per category.

    Ways lose coordinates without location; with fewer than two left they are
    dropped.  A way of three points or more counts as a polygon even if it is
    open, unless ``close_open_ways`` is false: then an open way gives the
    centroid of its line.  Areas are dropped when a coordinate has no
    location, when the outer ring crosses or touches itself, has a spike, or
    is flat."""
    df = union_elements(elements) if isinstance(elements, (list, tuple)) else elements
    any_rule = reduce(lambda a, b: a | b, [rule_condition(F.col("tags"), r) for r in rules.values()])
    known = F.filter("coords", _located)
    pts = df.filter(any_rule).withColumn("_known", known).withColumn("_pts", _projected(F.col("_known")))
    area = F.col("kind") == "area"
    pts = with_ring_validity(pts, "_known", "_simple", only=area)
    pts = pts.withColumn("_valid", F.col("_simple") & (F.size("_known") == F.size("coords")))
    ends = F.try_element_at("_known", F.lit(1)) == F.try_element_at("_known", F.lit(-1))
    pts = pts.withColumn("_closed", F.lit(True) if close_open_ways else ends)
    pts = with_representative_point(pts, closed="_closed", valid="_valid")
    # The NULL test rides inside the explode: as a Filter it would be pushed
    # below the projection with the whole centroid expression substituted.
    matched = match_categories(pts, rules, keep=F.col("pt").isNotNull())
    return matched.select("category", "kind", "id", name_or_empty("tags").alias("name"),
                          F.col("pt.x").alias("x_proj"), F.col("pt.y").alias("y_proj"))
