"""Spatial queries: projection, radius features, nearest POI, missing
flags, tag matching, centroids and same-name dedup.

Customers (and the sales through their customer) are the properties,
suppliers the points of interest; the oracle computes the radius features
by brute force over all customer x supplier pairs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from propspark.functions import scalar as S

from propspark.constants import POI_CATEGORIES
from propspark.functions.geo import lambert93_sql, with_ring_centroid
from propspark.functions.scalar import name_or_empty
from propspark.operators import impute, point_links, spatial
from propspark.plans.bindings import (DRIVER_RADII, category_sql, customer_points, lat_sql, lon_sql,
                                      poi_suppliers, radius_case_sql, table)
from propspark.plans.registry import register, with_ctes
from propspark.sources import map_elements


def _proj_sql(k: str) -> tuple[str, str]:
    return lambert93_sql(lon_sql(k), lat_sql(k))


_CX, _CY = _proj_sql("c_custkey")
_SX, _SY = _proj_sql("s_suppkey")

_PTS_SQL = f"""c AS (SELECT c_custkey, {lon_sql('c_custkey')} AS longitude, {lat_sql('c_custkey')} AS latitude,
                     {_CX} AS x, {_CY} AS y FROM customer),
p AS (SELECT {category_sql('s_suppkey')} AS category, s_suppkey AS id, {_SX} AS x, {_SY} AS y FROM supplier),
pr AS (SELECT c.c_custkey, p.category, p.id, sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)) AS dist
       FROM c JOIN p ON sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)) <= {radius_case_sql('p.category')})"""


def _feature_select_sql(key: str = "c.c_custkey", src: str = "c", pairs: str = "pr", fill: bool = False) -> str:
    cols = []
    for cat in POI_CATEGORIES:
        cols.append(f"CAST(count(CASE WHEN {pairs}.category = '{cat}' THEN 1 END) AS INTEGER) AS nb_{cat}")
        d = f"round_even(min(CASE WHEN {pairs}.category = '{cat}' THEN {pairs}.dist END), 2)"
        if fill:
            cols.append(f"coalesce({d}, {DRIVER_RADII[cat]!r}) AS distance_min_{cat}")
            cols.append(f"CAST({d} IS NULL AS INTEGER) AS distance_min_{cat}_manquante")
        else:
            cols.append(f"{d} AS distance_min_{cat}")
    return ",\n       ".join(cols)


def _poi(spark, d):
    return spatial.project(poi_suppliers(spark, d))


def _customers(spark, d):
    return spatial.project(customer_points(spark, d))


@register("project_l93", f"""
SELECT c_custkey, round({_CX}, 2) AS x_proj, round({_CY}, 2) AS y_proj FROM customer""")
def project_l93(spark, d):
    c = _customers(spark, d)
    return c.select("c_custkey", S.sql_round("x_proj", 2).alias("x_proj"), S.sql_round("y_proj", 2).alias("y_proj"))


@register("poi_features", with_ctes(_PTS_SQL) + f"""
SELECT c.c_custkey,
       {_feature_select_sql()}
FROM c LEFT JOIN pr ON c.c_custkey = pr.c_custkey GROUP BY c.c_custkey""")
def poi_features(spark, d):
    c = customer_points(spark, d)
    out = spatial.features_by_coordinates(c, _poi(spark, d), radii=DRIVER_RADII)
    return out.drop("longitude", "latitude")


@register("distance_missing_flags", with_ctes(_PTS_SQL) + f"""
SELECT c.c_custkey,
       {_feature_select_sql(fill=True)}
FROM c LEFT JOIN pr ON c.c_custkey = pr.c_custkey GROUP BY c.c_custkey""")
def distance_missing_flags(spark, d):
    c = customer_points(spark, d)
    feats = spatial.features_by_coordinates(c, _poi(spark, d), radii=DRIVER_RADII)
    return impute.distance_missing_flags(feats, radii=DRIVER_RADII).drop("longitude", "latitude")


@register("nearest_poi", with_ctes(_PTS_SQL) + """
SELECT c_custkey, category, id AS poi_id, round_even(dist, 2) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey, category ORDER BY dist, id) AS rn FROM pr)
WHERE rn = 1""")
def nearest_poi(spark, d):
    c = _customers(spark, d)
    out = spatial.nearest_poi(c, _poi(spark, d), ["c_custkey"], radii=DRIVER_RADII)
    return out.withColumn("dist", F.bround("dist", 2))


# Sales get the coordinates of their customer: many sales share one point,
# so the features are computed once per distinct coordinate.
_SALES_PTS_SQL = f"""c AS (SELECT o.o_orderkey, {lon_sql('o.o_custkey')} AS longitude, {lat_sql('o.o_custkey')} AS latitude,
                     {_proj_sql('o.o_custkey')[0]} AS x, {_proj_sql('o.o_custkey')[1]} AS y FROM orders o),
p AS (SELECT {category_sql('s_suppkey')} AS category, s_suppkey AS id, {_SX} AS x, {_SY} AS y FROM supplier),
pr AS (SELECT c.o_orderkey, p.category, p.id, sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)) AS dist
       FROM c JOIN p ON sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)) <= {radius_case_sql('p.category')})"""


@register("sales_geo_features", with_ctes(_SALES_PTS_SQL) + f"""
SELECT c.o_orderkey, c.longitude, c.latitude,
       {_feature_select_sql()}
FROM c LEFT JOIN pr ON c.o_orderkey = pr.o_orderkey GROUP BY c.o_orderkey, c.longitude, c.latitude""")
def sales_geo_features(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", (F.lit(-1.0) + (F.col("o_custkey") * 7919 % 9000).cast("double") / 1000.0).alias("longitude"),
        (F.lit(43.0) + (F.col("o_custkey") * 104729 % 7000).cast("double") / 1000.0).alias("latitude"))
    return spatial.features_by_coordinates(o, _poi(spark, d), radii=DRIVER_RADII)


# ------------------------------------------------------------ tag matching
# Driver tag rules over part attributes (category -> {tag: values | True}).
DRIVER_TAG_RULES = {
    "gares": {"type": ["ECONOMY"]},
    "commerces": {"type": ["SMALL", "MEDIUM"]},
    "education": {"brand": ["Brand#1", "Brand#2", "Brand#3"]},
    "espaces_verts": {"type": ["LARGE"], "brand": ["Brand#4"]},
    "sante": {"brand": ["Brand#5", "Brand#6"]},
    "pharmacies": {"type": ["PROMO"]},
    "aeroports": {"missing_tag": True},
    "routes_principales": {"name": True},
    "industries": {"type": ["STANDARD"], "brand": ["Brand#7"]},
}


# Outer rings of the areas (hundredths of a degree): a square, one that
# crosses itself, a closed triangle, a square with a spike, one that touches
# itself in a vertex.
AREA_SHAPES = [
    [(0, 0), (1, 0), (1, 1), (0, 1)],
    [(0, 0), (1, 0), (2, 1), (3, 1)],
    [(0, 0), (2, 0), (1, 2), (0, 0)],
    [(0, 0), (1, 0), (1, 1), (3, 1), (1, 1), (0, 1)],
    [(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1)],
]


def _elements(spark, d):
    """part rows as map elements: kind by key, tags from attributes (no
    name tag for every 5th key), coordinates around the key's location."""
    p = table(spark, d, "part")
    tags = F.when(F.col("p_partkey") % 5 == 0,
                  F.create_map(F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"))) \
        .otherwise(F.create_map(F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"),
                                F.lit("name"), F.col("p_name")))
    base = p.select("p_partkey", "p_size", F.col("p_partkey").alias("id"), tags.alias("tags"))
    kinds = {0: "node", 1: "way", 2: "area"}
    frames = []
    for r, kind in kinds.items():
        part = base.filter(F.col("p_partkey") % 3 == r)
        lon0 = F.lit(-1.0) + (F.col("p_partkey") * 7919 % 9000).cast("double") / 1000.0
        lat0 = F.lit(43.0) + (F.col("p_partkey") * 104729 % 7000).cast("double") / 1000.0
        npts = F.col("p_size") % 5 + 1 if kind == "way" else F.lit(1)
        steps = F.transform(F.sequence(F.lit(0), (npts - 1).cast("int")),
                            lambda i: F.struct(i.alias("dx"), F.when(i >= 2, 1).otherwise(0).alias("dy")))
        if kind == "area":
            shapes = F.array(*[F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ring])
                               for ring in AREA_SHAPES])
            steps = F.element_at(shapes, (F.floor(F.col("p_partkey") / 3) % len(AREA_SHAPES) + 1).cast("int"))
        coords = F.transform(steps, lambda s: F.struct((lon0 + s["dx"] * 0.01).alias("lon"), (lat0 + s["dy"] * 0.01).alias("lat")))
        frames.append(part.select(F.lit(kind).alias("kind"), "id", "tags", coords.alias("coords")))
    return frames


def _rule_sql(rule: dict) -> str:
    col = {"type": "p_type", "brand": "p_brand", "name": "(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END)",
           "missing_tag": "NULL"}
    parts = []
    for k, v in rule.items():
        parts.append(f"{col[k]} IS NOT NULL" if v is True else f"{col[k]} IN ({', '.join(repr(x) for x in v)})")
    return " OR ".join(parts)


_TAG_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS category, CASE p_partkey % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'area' END AS kind,
       p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS name
FROM part WHERE {_rule_sql(r)}""" for c, r in DRIVER_TAG_RULES.items())


@register("poi_tag_match", _TAG_SQL)
def poi_tag_match(spark, d):
    elements = map_elements.union_elements(_elements(spark, d))
    matched = map_elements.match_categories(elements, DRIVER_TAG_RULES)
    return matched.select("category", "kind", "id", name_or_empty("tags").alias("name"))


_SHAPE_SQL = ", ".join(f"({k}, {i}, {dx}, {dy})" for k, ring in enumerate(AREA_SHAPES) for i, (dx, dy) in enumerate(ring))
_EX, _EY = lambert93_sql("lon", "lat")

_EXTRACT_SQL = f"""e AS (SELECT p_partkey AS id, p_partkey % 3 AS kind, {lon_sql('p_partkey')} AS lon0, {lat_sql('p_partkey')} AS lat0,
  p_size % 5 + 1 AS n, (p_partkey // 3) % {len(AREA_SHAPES)} AS shape FROM part),
o AS (SELECT id, kind, lon0, lat0, i, i AS dx, CASE WHEN i >= 2 THEN 1 ELSE 0 END AS dy
      FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 1 ELSE n END)) AS i FROM e WHERE kind < 2)
      UNION ALL SELECT id, kind, lon0, lat0, v.i, v.dx, v.dy
      FROM e JOIN (VALUES {_SHAPE_SQL}) v(shape, i, dx, dy) ON e.shape = v.shape WHERE kind = 2),
l AS (SELECT id, kind, i, lon0 + dx * 0.01::DOUBLE AS lon, lat0 + dy * 0.01::DOUBLE AS lat FROM o),
m AS (SELECT id, kind, i, {_EX} AS x, {_EY} AS y, round(lon * 1e7)::BIGINT AS gx, round(lat * 1e7)::BIGINT AS gy FROM l),
w AS (SELECT *, first_value(x) OVER p AS x0, first_value(y) OVER p AS y0, lead(x) OVER p AS xl, lead(y) OVER p AS yl,
        coalesce(lead(gx) OVER p, first_value(gx) OVER p) AS gxn, coalesce(lead(gy) OVER p, first_value(gy) OVER p) AS gyn
      FROM m WINDOW p AS (PARTITION BY id ORDER BY i)),
s AS (SELECT *, sqrt((xl - x) * (xl - x) + (yl - y) * (yl - y)) AS len,
        (x - x0) * (coalesce(yl, y0) - y0) - (coalesce(xl, x0) - x0) * (y - y0) AS cr FROM w),
c AS (SELECT id, kind, count(*) AS n, any_value(x0) AS x0, any_value(y0) AS y0, sum(cr) AS a2,
        sum(((x - x0) + (coalesce(xl, x0) - x0)) * cr) AS cx, sum(((y - y0) + (coalesce(yl, y0) - y0)) * cr) AS cy,
        coalesce(sum(len), 0) AS len, sum(len * (x + xl) / 2) AS sx, sum(len * (y + yl) / 2) AS sy FROM s GROUP BY id, kind),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS k, count(*) OVER (PARTITION BY id) AS nr
      FROM w WHERE kind = 2 AND (gx, gy) <> (gxn, gyn)),
g AS (SELECT a.id, a.k, a.nr, a.gx AS x1, a.gy AS y1, b.gx AS x2, b.gy AS y2 FROM r a JOIN r b ON a.id = b.id AND b.k = a.k % a.nr + 1),
bad AS (SELECT DISTINCT s.id FROM g s JOIN g t ON s.id = t.id AND s.k < t.k WHERE CASE
  WHEN t.k = s.k + 1 THEN (s.x2 - s.x1) * (t.y2 - s.y1) = (s.y2 - s.y1) * (t.x2 - s.x1)
       AND (s.x2 - s.x1) * (t.x2 - t.x1) + (s.y2 - s.y1) * (t.y2 - t.y1) < 0
  WHEN s.k = 1 AND t.k = s.nr THEN (t.x2 - t.x1) * (s.y2 - t.y1) = (t.y2 - t.y1) * (s.x2 - t.x1)
       AND (t.x2 - t.x1) * (s.x2 - s.x1) + (t.y2 - t.y1) * (s.y2 - s.y1) < 0
  ELSE greatest(s.x1, s.x2) >= least(t.x1, t.x2) AND greatest(t.x1, t.x2) >= least(s.x1, s.x2)
       AND greatest(s.y1, s.y2) >= least(t.y1, t.y2) AND greatest(t.y1, t.y2) >= least(s.y1, s.y2)
       AND sign((s.x2 - s.x1) * (t.y1 - s.y1) - (s.y2 - s.y1) * (t.x1 - s.x1))
         * sign((s.x2 - s.x1) * (t.y2 - s.y1) - (s.y2 - s.y1) * (t.x2 - s.x1)) <= 0
       AND sign((t.x2 - t.x1) * (s.y1 - t.y1) - (t.y2 - t.y1) * (s.x1 - t.x1))
         * sign((t.x2 - t.x1) * (s.y2 - t.y1) - (t.y2 - t.y1) * (s.x2 - t.x1)) <= 0 END),
pt AS (SELECT id, CASE WHEN kind = 0 OR n = 1 THEN x0 WHEN abs(a2) <= 1e-9 * len * len OR n = 2 THEN sx / len ELSE x0 + cx / (3 * a2) END AS x,
         CASE WHEN kind = 0 OR n = 1 THEN y0 WHEN abs(a2) <= 1e-9 * len * len OR n = 2 THEN sy / len ELSE y0 + cy / (3 * a2) END AS y
       FROM c WHERE kind = 0 OR (kind = 1 AND n >= 2) OR (kind = 2 AND id NOT IN (SELECT id FROM bad))),
tags AS ({_TAG_SQL})"""


@register("poi_extract", with_ctes(_EXTRACT_SQL) + """
SELECT category, tags.kind, tags.id, name, round(pt.x, 3) AS x_proj, round(pt.y, 3) AS y_proj FROM tags JOIN pt ON pt.id = tags.id""")
def poi_extract(spark, d):
    """S10 + P11 + G2 + U2 + F24 end to end; the SQL computes centroids and
    tests every pair of segments of every area."""
    poi = map_elements.extract_poi(_elements(spark, d), DRIVER_TAG_RULES)
    return poi.withColumns({c: S.sql_round(c, 3) for c in ("x_proj", "y_proj")})


@register("ring_centroid", """
SELECT p_partkey,
       round(CASE WHEN p_partkey % 4 = 0 THEN x0 + w / 3.0 ELSE x0 + w / 2.0 END, 6) AS cx,
       round(CASE WHEN p_partkey % 4 = 0 THEN y0 + h / 3.0 ELSE y0 + h / 2.0 END, 6) AS cy
FROM (SELECT p_partkey, CAST(p_partkey % 1000 AS DOUBLE) * 10 AS x0, CAST(p_partkey % 777 AS DOUBLE) * 10 AS y0,
             CAST(p_size AS DOUBLE) * 10 AS w, CAST(p_partkey % 13 + 1 AS DOUBLE) * 10 AS h FROM part)""")
def ring_centroid_q(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", ((F.col("p_partkey") % 1000).cast("double") * 10).alias("x0"),
        ((F.col("p_partkey") % 777).cast("double") * 10).alias("y0"),
        (F.col("p_size").cast("double") * 10).alias("w"),
        ((F.col("p_partkey") % 13 + 1).cast("double") * 10).alias("h"))

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    x0, y0, w, h = F.col("x0"), F.col("y0"), F.col("w"), F.col("h")
    rect = F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0 + w, y0 + h), pt(x0, y0 + h))
    tri = F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0, y0 + h))
    rings = p.withColumn("ring", F.when(F.col("p_partkey") % 4 == 0, tri).otherwise(rect))
    c = with_ring_centroid(rings, "ring", "c")
    return c.select("p_partkey", S.sql_round("c.x", 6).alias("cx"), S.sql_round("c.y", 6).alias("cy"))


# ------------------------------------------------------------- POI dedup
DEDUP_THRESHOLD_DRIVER = 150000.0  # metres: supplier points are ~70 km apart


def _named_suppliers(spark, d):
    s = table(spark, d, "supplier")
    pts = s.select(F.col("s_suppkey").alias("ord"),
                   F.concat(F.lit("S"), (F.col("s_suppkey") % 7).cast("string")).alias("name"),
                   (F.lit(-1.0) + (F.col("s_suppkey") * 7919 % 9000).cast("double") / 1000.0).alias("longitude"),
                   (F.lit(43.0) + (F.col("s_suppkey") * 104729 % 7000).cast("double") / 1000.0).alias("latitude"))
    return spatial.project(pts)


_NAMED_SQL = f"""pts AS (SELECT s_suppkey AS ord, 'S' || CAST(s_suppkey % 7 AS VARCHAR) AS name,
                     {_SX} AS x, {_SY} AS y FROM supplier)"""


@register("poi_same_name_pairs", with_ctes(_NAMED_SQL) + f"""
SELECT a.ord AS a, b.ord AS b FROM pts a JOIN pts b
  ON a.name = b.name AND b.ord < a.ord
 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {DEDUP_THRESHOLD_DRIVER!r}""")
def poi_same_name_pairs(spark, d):
    return spatial.same_name_edges(_named_suppliers(spark, d), DEDUP_THRESHOLD_DRIVER)


_SIDE = repr(point_links.CELL * DEDUP_THRESHOLD_DRIVER)


@register("poi_same_name_classes", with_ctes(_NAMED_SQL) + f"""
SELECT a.ord, min(a.ord) OVER (PARTITION BY a.name, floor(a.x / {_SIDE}), floor(a.y / {_SIDE})) AS class_id,
       (SELECT count(*) FROM pts b WHERE b.name = a.name AND b.ord <> a.ord
        AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {DEDUP_THRESHOLD_DRIVER!r}) AS n_links
FROM pts a""")
def poi_same_name_classes(spark, d):
    """J9 as classes: each POI's class and its number of links."""
    return point_links.same_name_links(_named_suppliers(spark, d), DEDUP_THRESHOLD_DRIVER)[0]


@register("poi_dedup_greedy", "WITH RECURSIVE " + _NAMED_SQL + f""",
seq AS (SELECT row_number() OVER (ORDER BY ord) AS rn, * FROM pts),
g(rn, kept) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT g.rn + 1,
         CASE WHEN EXISTS (SELECT 1 FROM seq q WHERE list_contains(g.kept, q.ord) AND q.name = s.name
                           AND sqrt((q.x - s.x) * (q.x - s.x) + (q.y - s.y) * (q.y - s.y)) <= {DEDUP_THRESHOLD_DRIVER!r})
              THEN g.kept ELSE list_append(g.kept, s.ord) END
  FROM g JOIN seq s ON s.rn = g.rn + 1)
SELECT ord, name FROM pts
WHERE list_contains((SELECT kept FROM g ORDER BY rn DESC LIMIT 1), ord)""")
def poi_dedup_greedy(spark, d):
    kept = spatial.greedy_dedup(_named_suppliers(spark, d), DEDUP_THRESHOLD_DRIVER)
    return kept.select("ord", "name")
