"""Planar geometry as column expressions.

G1: longitude / latitude (WGS84 degrees) -> Lambert-93 metres, closed form of
the Lambert conformal conic projection on the GRS80 ellipsoid (two standard
parallels 44 N / 49 N, origin 3 E / 46.5 N, false origin 700000 / 6600000).
The constants below are derived from those published parameters.

G2: representative point of a node / line / ring.
G3: Euclidean distance in metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Lambert-93 parameters (public definition of the projection).
_A = 6378137.0                      # GRS80 semi-major axis
_F = 1 / 298.257222101              # GRS80 flattening
_E = math.sqrt(_F * (2 - _F))       # first eccentricity
_PHI1, _PHI2 = math.radians(44.0), math.radians(49.0)
_PHI0, _LAM0 = math.radians(46.5), math.radians(3.0)
_X0, _Y0 = 700000.0, 6600000.0


def _m(phi):
    return math.cos(phi) / math.sqrt(1 - (_E * math.sin(phi)) ** 2)


def _t(phi):
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)


_N = (math.log(_m(_PHI1)) - math.log(_m(_PHI2))) / (math.log(_t(_PHI1)) - math.log(_t(_PHI2)))
_C = _A * _m(_PHI1) / (_N * _t(_PHI1) ** _N)
_YS = _Y0 + _C * _t(_PHI0) ** _N


def _rho_theta(lon: Column, lat: Column):
    phi = F.radians(lat.cast("double"))
    lam = F.radians(lon.cast("double"))
    es = F.lit(_E) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(_E / 2))
    rho = F.lit(_C) * F.pow(t, F.lit(_N))
    theta = F.lit(_N) * (lam - F.lit(_LAM0))
    return rho, theta


def lambert93_x(lon, lat) -> Column:
    rho, theta = _rho_theta(_c(lon), _c(lat))
    return F.lit(_X0) + rho * F.sin(theta)


def lambert93_y(lon, lat) -> Column:
    rho, theta = _rho_theta(_c(lon), _c(lat))
    return F.lit(_YS) - rho * F.cos(theta)


def lambert93_constants() -> dict:
    """Numeric constants, for writing the same formula in SQL oracles."""
    return {"e": _E, "n": _N, "C": _C, "Ys": _YS, "x0": _X0, "lam0": _LAM0}


def lambert93_sql(lon: str, lat: str) -> tuple[str, str]:
    """The same projection as SQL text (Spark and DuckDB accept it)."""
    k = lambert93_constants()
    phi = f"radians(CAST({lat} AS DOUBLE))"
    lam = f"radians(CAST({lon} AS DOUBLE))"
    es = f"({k['e']!r} * sin({phi}))"
    t = f"(tan({math.pi / 4!r} - {phi} / 2) / pow((1.0 - {es}) / (1.0 + {es}), {k['e'] / 2!r}))"
    rho = f"({k['C']!r} * pow({t}, {k['n']!r}))"
    theta = f"({k['n']!r} * ({lam} - {k['lam0']!r}))"
    return (f"({k['x0']!r} + {rho} * sin({theta}))", f"({k['Ys']!r} - {rho} * cos({theta}))")


# G3 -------------------------------------------------------------------------
def euclidean(x1, y1, x2, y2) -> Column:
    dx = _c(x1) - _c(x2)
    dy = _c(y1) - _c(y2)
    return F.sqrt(dx * dx + dy * dy)


# G2 -------------------------------------------------------------------------
def _rotated(pts: Column) -> Column:
    """[p2, ..., pn, p1]: the next vertex of every vertex of a closed ring."""
    n = F.size(pts)
    return F.concat(F.slice(pts, 2, n), F.slice(pts, 1, 1))


# The centroids are split in two steps, each meant to become its own
# column: Spark shares no sub-expression inside or across lambdas, so an
# array expression or an accumulator used several times would otherwise be
# recomputed for every use (tens of times per row).

def ring_sums(pts: Column, x: str = "x", y: str = "y") -> Column:
    """Shoelace sums of a ring (ARRAY<STRUCT<x,y>> column), relative to the
    first vertex so that metre coordinates near 10^6 keep their precision.
    The ring is closed implicitly (a repeated closing point adds nothing)."""
    first = F.try_element_at(pts, F.lit(1))
    ox, oy = first[x], first[y]
    pairs = F.arrays_zip(pts.alias("a"), _rotated(pts).alias("b"))
    zero = F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))

    def step(acc, z):
        ax, ay = z["a"][x] - ox, z["a"][y] - oy
        bx, by = z["b"][x] - ox, z["b"][y] - oy
        cr = ax * by - bx * ay
        return F.struct((acc["a2"] + cr).alias("a2"), (acc["cx"] + (ax + bx) * cr).alias("cx"),
                        (acc["cy"] + (ay + by) * cr).alias("cy"))

    acc = F.aggregate(pairs, zero, step)
    return F.struct(acc.alias("s"), ox.alias("ox"), oy.alias("oy"))


def ring_centroid_from_sums(sums: Column) -> Column:
    """Centroid from ``ring_sums``; a zero-area ring gives NULL."""
    a2 = sums["s"]["a2"]
    return F.when(a2 != 0, F.struct((sums["ox"] + sums["s"]["cx"] / (3 * a2)).alias("x"),
                                    (sums["oy"] + sums["s"]["cy"] / (3 * a2)).alias("y")))


def line_sums(pts: Column, x: str = "x", y: str = "y") -> Column:
    """Length-weighted sums of a polyline column."""
    n = F.size(pts)
    m = F.greatest(n - 1, F.lit(0))
    segs = F.arrays_zip(F.slice(pts, 1, m).alias("a"), F.slice(pts, 2, m).alias("b"))
    zero = F.struct(F.lit(0.0).alias("L"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def step(acc, s):
        x1, y1, x2, y2 = s["a"][x], s["a"][y], s["b"][x], s["b"][y]
        ln = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
        return F.struct((acc["L"] + ln).alias("L"), (acc["sx"] + ln * (x1 + x2) / 2).alias("sx"),
                        (acc["sy"] + ln * (y1 + y2) / 2).alias("sy"))

    first = F.try_element_at(pts, F.lit(1))
    return F.struct(F.aggregate(segs, zero, step).alias("s"), first[x].alias("fx"), first[y].alias("fy"))


def line_centroid_from_sums(sums: Column) -> Column:
    """Centroid from ``line_sums``; a zero-length line gives its first point."""
    L = sums["s"]["L"]
    return F.when(L > 0, F.struct((sums["s"]["sx"] / L).alias("x"), (sums["s"]["sy"] / L).alias("y"))) \
        .otherwise(F.struct(sums["fx"].alias("x"), sums["fy"].alias("y")))


def with_ring_centroid(df, pts: str, out: str, x: str = "x", y: str = "y"):
    """DataFrame step: ``out`` = centroid of the ring column ``pts``."""
    return (df.withColumn("_ring_sums", ring_sums(F.col(pts), x, y))
            .withColumn(out, ring_centroid_from_sums(F.col("_ring_sums"))).drop("_ring_sums"))




def with_line_centroid(df, pts: str, out: str, x: str = "x", y: str = "y"):
    """DataFrame step: ``out`` = centroid of the polyline column ``pts``."""
    return (df.withColumn("_line_sums", line_sums(F.col(pts), x, y))
            .withColumn(out, line_centroid_from_sums(F.col("_line_sums"))).drop("_line_sums"))


# Ring validity ----------------------------------------------------------------
#: Coordinates are compared at this resolution (the map data's own), as whole
#: numbers: products of two differences of degrees then fit a long.
_PER_DEGREE = 10_000_000
#: Consecutive segments whose common box is tested before they are.
_SEGMENTS = 32


def _left_right(a, b, c) -> tuple[Column, Column]:
    """Two numbers of which the first is greater where ``c`` lies left of the
    line from ``a`` to ``b``, and less where it lies right."""
    return (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])


def _one_side(a, b, c, d) -> Column:
    """``c`` and ``d`` lie strictly on one side of the line from ``a`` to ``b``."""
    (p, q), (r, s) = _left_right(a, b, c), _left_right(a, b, d)
    return ((p > q) & (r > s)) | ((p < q) & (r < s))


def _apart(s: Column, t: Column) -> Column:
    return (s["hx"] < t["lx"]) | (t["hx"] < s["lx"]) | (s["hy"] < t["ly"]) | (t["hy"] < s["ly"])


def _clash(s: Column, t: Column, n: Column) -> Column:
    """Two segments of a ring of ``n``, ``s`` before ``t``, break its validity:
    they meet anywhere but at the vertex that neighbours share, or neighbours
    lie on top of each other (a spike)."""
    a, b, c, d = (s["x1"], s["y1"]), (s["x2"], s["y2"]), (t["x1"], t["y1"]), (t["x2"], t["y2"])
    follows, closes = t["i"] == s["i"] + 1, (s["i"] == 0) & (t["i"] == n - 1)

    def spike(p, q, r) -> Column:
        left, right = _left_right(p, q, r)
        back = (q[0] - p[0]) * (r[0] - q[0]) + (q[1] - p[1]) * (r[1] - q[1]) < 0
        return (left == right) & back

    meet = ~_one_side(a, b, c, d) & ~_one_side(c, d, a, b)
    return F.when(follows, spike(a, b, d)).when(closes, spike(c, d, b)).otherwise(meet)


def with_ring_validity(df, coords: str, out: str, only: Column | None = None, lon: str = "lon", lat: str = "lat"):
    """DataFrame step: ``out`` = the closed ring of ``coords`` (degrees) is
    valid: at least three distinct vertices, no segment that crosses, touches
    or overlaps another beyond the vertex that neighbours share.  Repeated
    consecutive points count once.  NULL where ``only`` does not hold.

    All in whole numbers, so exact.  Segments are compared only where the
    boxes of their blocks of consecutive segments overlap, and then their own
    boxes.  Each array is a column of its own, since lambdas share nothing."""
    grid = F.transform(F.col(coords), lambda p: F.struct(F.round(p[lon] * _PER_DEGREE).cast("long").alias("x"),
                                                         F.round(p[lat] * _PER_DEGREE).cast("long").alias("y")))
    df = df.withColumn("_grid", grid if only is None else F.when(only, grid))
    before = lambda i: F.element_at("_grid", F.when(i == 0, F.size("_grid")).otherwise(i))
    df = df.withColumn("_ring", F.filter("_grid", lambda p, i: p != before(i)))
    df = df.withColumn("_seg", F.transform(F.arrays_zip(F.col("_ring").alias("a"), _rotated(F.col("_ring")).alias("b")), lambda z, i: F.struct(
        i.alias("i"), z["a"]["x"].alias("x1"), z["a"]["y"].alias("y1"), z["b"]["x"].alias("x2"), z["b"]["y"].alias("y2"),
        F.least(z["a"]["x"], z["b"]["x"]).alias("lx"), F.greatest(z["a"]["x"], z["b"]["x"]).alias("hx"),
        F.least(z["a"]["y"], z["b"]["y"]).alias("ly"), F.greatest(z["a"]["y"], z["b"]["y"]).alias("hy"))))
    n = F.size("_seg")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _SEGMENTS).cast("int")), lambda k: F.slice("_seg", k * _SEGMENTS + 1, _SEGMENTS))
    df = df.withColumn("_blocks", F.when(n >= 3, blocks))
    df = df.withColumn("_boxes", F.transform("_blocks", lambda b: F.struct(
        b.alias("s"), F.element_at(b, 1)["i"].alias("i"),
        F.array_min(F.transform(b, lambda t: t["lx"])).alias("lx"), F.array_max(F.transform(b, lambda t: t["hx"])).alias("hx"),
        F.array_min(F.transform(b, lambda t: t["ly"])).alias("ly"), F.array_max(F.transform(b, lambda t: t["hy"])).alias("hy"))))
    crossed = F.exists("_boxes", lambda a: F.exists("_boxes", lambda b: (a["i"] <= b["i"]) & ~_apart(a, b) & F.exists(
        a["s"], lambda s: F.exists(b["s"], lambda t: (s["i"] < t["i"]) & ~_apart(s, t) & _clash(s, t, n)))))
    valid = F.coalesce(~crossed, F.lit(False))
    return (df.withColumn(out, valid if only is None else F.when(only, valid))
            .drop("_grid", "_ring", "_seg", "_blocks", "_boxes"))
