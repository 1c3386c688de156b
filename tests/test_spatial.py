"""Radius join, nearest POI and greedy dedup against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from propspark.operators import spatial
from propspark.sources import map_elements

RADII = {"a": 100.0, "b": 250.0, "c": 1000.0}


def _points(n, seed, spread=3000.0):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(-spread, spread), rnd.uniform(-spread, spread)) for i in range(n)]


def _brute(points, pois, radii):
    out = {}
    for k, x, y in points:
        row = {}
        for cat, r in radii.items():
            ds = [math.hypot(x - px, y - py) for c, _, px, py in pois if c == cat and math.hypot(x - px, y - py) <= r]
            row[cat] = (len(ds), round(min(ds), 2) if ds else None)
        out[k] = row
    return out


@pytest.mark.parametrize("salt", [1, 4])
def test_radius_features_match_brute_force(spark, salt):
    pts = _points(300, 1)
    rnd = random.Random(2)
    pois = [(rnd.choice(list(RADII)), i, rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(200)]
    # exact radius hits and cell-border points (inclusive test, negative cells)
    pois += [("a", 1000, pts[0][1] + 100.0, pts[0][2]), ("b", 1001, -250.0, -250.0), ("c", 1002, 0.0, -1000.0)]
    pts += [(900, -250.0, 0.0), (901, 0.0, 0.0)]
    p_df = spark.createDataFrame(pts, "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame(pois, "category string, id long, x_proj double, y_proj double")
    kw = {"broadcast_bytes": 0, "salt_buckets": salt} if salt > 1 else {}
    got = spatial.radius_features(p_df, poi_df, ["k"], list(RADII), RADII, **kw).collect()
    exp = _brute(pts, pois, RADII)
    assert len(got) == len(pts)
    for r in got:
        for cat in RADII:
            n, d = exp[r.k][cat]
            assert r[f"nb_{cat}"] == n, (r.k, cat)
            assert (r[f"distance_min_{cat}"] is None) == (d is None)
            if d is not None:
                assert r[f"distance_min_{cat}"] == pytest.approx(d, abs=0.0051)


def test_empty_category_gives_zero_and_null(spark):
    p_df = spark.createDataFrame([(1, 0.0, 0.0)], "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame([("a", 1, 10.0, 0.0)], "category string, id long, x_proj double, y_proj double")
    r = spatial.radius_features(p_df, poi_df, ["k"], list(RADII), RADII).first()
    assert (r.nb_a, r.distance_min_a, r.nb_c, r.distance_min_c) == (1, 10.0, 0, None)


def test_nearest_poi_matches_brute_force(spark):
    pts = _points(100, 3)
    rnd = random.Random(4)
    pois = [(rnd.choice(list(RADII)), i, rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(150)]
    p_df = spark.createDataFrame(pts, "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame(pois, "category string, id long, x_proj double, y_proj double")
    got = {(r.k, r.category): (r.poi_id, r.dist)
           for r in spatial.nearest_poi(p_df, poi_df, ["k"], list(RADII), RADII).collect()}
    exp = {}
    for k, x, y in pts:
        for c, i, px, py in pois:
            d = math.hypot(x - px, y - py)
            if d <= RADII[c] and ((k, c) not in exp or (d, i) < (exp[(k, c)][1], exp[(k, c)][0])):
                exp[(k, c)] = (i, d)
    assert got.keys() == exp.keys()
    for key, (i, d) in exp.items():
        assert got[key][0] == i and got[key][1] == pytest.approx(d)


def test_features_by_coordinates_joins_back_on_duplicates(spark):
    sales = spark.createDataFrame([(1, 2.35, 48.85), (2, 2.35, 48.85), (3, 5.0, 45.0), (4, None, 45.0)],
                                  "sale long, longitude double, latitude double")
    poi = spatial.project(spark.createDataFrame([("a", 1, 2.351, 48.8505)],
                                                "category string, id long, longitude double, latitude double"))
    out = {r.sale: r for r in spatial.features_by_coordinates(sales, poi, categories=["a"], radii={"a": 1000.0}).collect()}
    assert out[1].nb_a == out[2].nb_a == 1 and out[1].distance_min_a == out[2].distance_min_a
    assert out[3].nb_a == 0 and out[3].distance_min_a is None
    assert out[4].nb_a is None  # no coordinates: no features


def _sequential_greedy(rows, threshold):
    kept = []
    for o, name, x, y in sorted(rows):
        if not any(n == name and math.hypot(x - kx, y - ky) <= threshold for _, n, kx, ky in kept):
            kept.append((o, name, x, y))
    return sorted(o for o, *_ in kept)


def test_greedy_dedup_chain_and_borders(spark):
    rows = [(1, "A", 0.0, 0.0), (2, "A", 20.0, 0.0), (3, "A", 40.0, 0.0),      # chain: keep 1 and 3
            (4, "B", 0.0, 0.0), (5, "B", 25.0, 0.0), (6, "B", 50.01, 0.0),     # 25 m inclusive
            (7, "", 5.0, 5.0), (8, "", 5.0, 5.0), (9, "", 500.0, 5.0),         # unnamed, exact copies
            (10, "C", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "ord long, name string, x_proj double, y_proj double")
    got = sorted(r.ord for r in spatial.greedy_dedup(df, 25.0).collect())
    assert got == _sequential_greedy(rows, 25.0) == [1, 3, 4, 6, 7, 9, 10]


def test_greedy_dedup_matches_sequential_on_random_points(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["P", "Q", ""]), rnd.uniform(0, 300), rnd.uniform(0, 300)) for i in range(400)]
    rows += [(400 + i, "P", rows[i][2], rows[i][3]) for i in range(0, 40, 3)]  # exact copies
    df = spark.createDataFrame(rows, "ord long, name string, x_proj double, y_proj double")
    got = sorted(r.ord for r in spatial.greedy_dedup(df, 25.0).collect())
    assert got == _sequential_greedy(rows, 25.0)


def test_extract_poi_tag_rules_and_geometry(spark):
    schema = "kind string, id long, tags map<string,string>, coords array<struct<lon:double,lat:double>>"
    els = [
        ("node", 1, {"amenity": "pharmacy", "shop": "convenience", "name": "P1"}, [(3.0, 46.5)]),   # 2 categories
        ("way", 2, {"leisure": "park"}, [(3.0, 46.5)]),                                          # 1 point: dropped
        ("way", 3, {"leisure": "park", "name": "L"}, [(3.0, 46.5), (3.002, 46.5)]),              # line
        ("way", 4, {"public_transport": "station"}, [(3.0, 46.5), (3.01, 46.5), (3.01, 46.51)]),  # forced polygon
        ("area", 5, {"aeroway": "aerodrome"}, [(3.0, 46.5), (3.0, 46.5), (3.0, 46.5)]),          # zero area: dropped
        ("node", 6, {"amenity": "bank"}, [(3.0, 46.5)]),                                         # no rule
        ("way", 7, {"highway": "trunk"}, [(None, 46.5), (3.0, 46.5), (3.001, 46.5)]),            # invalid point removed
    ]
    df = spark.createDataFrame(els, schema)
    out = map_elements.extract_poi(df).collect()
    got = sorted((r.category, r.id, r.name) for r in out)
    assert got == [("commerces", 1, "P1"), ("espaces_verts", 3, "L"), ("gares", 4, ""),
                   ("pharmacies", 1, "P1"), ("routes_principales", 7, "")]
    pt = {r.id: (r.x_proj, r.y_proj) for r in out}
    assert pt[1] == (pytest.approx(700000.0, abs=1e-6), pytest.approx(6600000.0, abs=1e-6))
    assert pt[3][0] > 700000.0  # line centroid between its two ends


def test_greedy_dedup_dense_near_duplicates(spark):
    # 500 same-name points jittered within a 60 m square, in shuffled order:
    # the round-based dedup must equal the sequential scan without pairing
    # every point with every other one.
    rnd = random.Random(11)
    ords = list(range(500))
    rnd.shuffle(ords)
    rows = [(ords[i], "Pharmacie", 1000.0 + rnd.uniform(0, 60), 2000.0 + rnd.uniform(0, 60)) for i in range(500)]
    rows += [(1000 + i, "", rnd.uniform(0, 60), rnd.uniform(0, 60)) for i in range(50)]
    df = spark.createDataFrame(rows, "ord long, name string, x_proj double, y_proj double")
    got = sorted(r.ord for r in spatial.greedy_dedup(df, 25.0).collect())
    assert got == _sequential_greedy(rows, 25.0)


def test_features_join_back_salted_equals_plain(spark):
    sales = spark.createDataFrame([(i, 2.35 if i % 3 else 5.0, 48.85) for i in range(60)],
                                  "sale long, longitude double, latitude double")
    poi = spatial.project(spark.createDataFrame([("a", 1, 2.351, 48.8505)],
                                                "category string, id long, longitude double, latitude double"))
    a = sorted(map(tuple, spatial.features_by_coordinates(sales, poi, categories=["a"], radii={"a": 1000.0}).collect()))
    b = sorted(map(tuple, spatial.features_by_coordinates(sales, poi, categories=["a"], radii={"a": 1000.0},
                                                          join_back_salt=4).collect()))
    assert a == b and len(a) == 60


def test_nearest_poi_salted_shuffle_path(spark):
    pts = _points(80, 21)
    rnd = random.Random(22)
    pois = [(rnd.choice(list(RADII)), i, rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(120)]
    p_df = spark.createDataFrame(pts, "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame(pois, "category string, id long, x_proj double, y_proj double")
    plain = sorted(map(tuple, spatial.nearest_poi(p_df, poi_df, ["k"], list(RADII), RADII).collect()))
    salted = sorted(map(tuple, spatial.nearest_poi(p_df, poi_df, ["k"], list(RADII), RADII,
                                                   broadcast_bytes=0, salt_buckets=3).collect()))
    assert plain == salted


def test_poi_chain_extract_dedup_features(spark):
    """S10 -> G4 per category in (kind, id) order -> G5 on a sale."""
    schema = "kind string, id long, tags map<string,string>, coords array<struct<lon:double,lat:double>>"
    sq = [(3.0, 46.5), (3.0001, 46.5), (3.0001, 46.5001), (3.0, 46.5001)]
    els = [
        ("way", 10, {"leisure": "park", "name": "Parc"}, sq),            # closed way ...
        ("area", 10, {"leisure": "park", "name": "Parc"}, sq),           # ... also an area (Q8): removed
        ("node", 20, {"amenity": "pharmacy", "name": "Ph"}, [(3.0, 46.5)]),
        ("node", 21, {"amenity": "pharmacy", "name": "Ph"}, [(3.0001, 46.5)]),   # ~7.6 m away: removed
        ("node", 22, {"amenity": "doctors", "name": "Ph"}, [(3.0001, 46.5)]),    # other category: kept
        ("node", 30, {"shop": "supermarket", "name": "S"}, [(3.01, 46.5)]),
    ]
    pois = map_elements.extract_poi(spark.createDataFrame(els, schema))
    kept = spatial.dedup_pois(pois)
    got = sorted((r.category, r.kind, r.id) for r in kept.collect())
    assert got == [("commerces", "node", 30), ("espaces_verts", "way", 10),
                   ("pharmacies", "node", 20), ("sante", "node", 22)]
    sales = spark.createDataFrame([(1, 3.0, 46.5)], "sale long, longitude double, latitude double")
    f = spatial.features_by_coordinates(sales, kept).first()
    assert (f.nb_pharmacies, f.nb_espaces_verts, f.nb_sante, f.nb_commerces, f.nb_gares) == (1, 1, 1, 0, 0)
    assert f.distance_min_pharmacies == 0.0 and f.distance_min_commerces is None


def test_flat_ways_keep_their_line_centroid(spark):
    from propspark.sources.map_elements import extract_poi
    pts = lambda *xy: [{"lon": float(x), "lat": float(y)} for x, y in xy]
    rows = [("way", 1, {"highway": "motorway"}, pts((2, 48), (2.01, 48), (2, 48))),
            ("way", 2, {"highway": "trunk"}, pts((2, 48), (2, 48.005), (2, 48.01))),
            ("area", 3, {"leisure": "park"}, pts((2, 48), (2.01, 48), (2, 48)))]
    df = spark.createDataFrame(rows, "kind string, id long, tags map<string,string>, "
                                     "coords array<struct<lon:double,lat:double>>")
    assert sorted(r.id for r in extract_poi(df).collect()) == [1, 2]


def _valid_ring(ring):
    """Every pair of segments, by exact integers."""
    n0 = len(ring)
    pts = [p for k, p in enumerate(ring) if p != ring[k - 1 if k else n0 - 1]]
    n = len(pts)
    if n < 3:
        return False
    seg = [(pts[k], pts[(k + 1) % n]) for k in range(n)]

    def side(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    def within(a, b, p):
        return min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])

    for i in range(n):
        for j in range(i + 1, n):
            (a, b), (c, d) = seg[i], seg[j]
            if j == i + 1 or (i == 0 and j == n - 1):
                p, q, r = (a, b, d) if j == i + 1 else (c, d, b)
                # On one line and the outer ends on the same side of the shared vertex.
                if side(p, q, r) == 0 and (q[0] - p[0]) * (r[0] - q[0]) + (q[1] - p[1]) * (r[1] - q[1]) < 0:
                    return False
                continue
            s = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
            if s[0] * s[1] < 0 and s[2] * s[3] < 0:
                return False
            if any(o == 0 and within(x, y, p) for o, (x, y, p) in zip(s, ((a, b, c), (a, b, d), (c, d, a), (c, d, b)))):
                return False
    return True


def test_ring_validity_equals_all_segment_pairs(spark):
    from propspark.functions.geo import with_ring_validity
    rnd = random.Random(41)
    rings = [[(0, 0), (1, 0), (1, 1), (0, 1)], [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [(0, 0), (1, 1), (1, 0), (0, 1)], [], [(2, 2)],
             [(0, 0), (1, 1)], [(0, 0), (1, 1), (0, 0)], [(3, 3)] * 5, [(0, 0), (2, 0), (1, 0), (1, 1)], [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)]]
    for _ in range(400):
        rings.append([(rnd.randrange(6), rnd.randrange(6)) for _ in range(rnd.randrange(3, 8))])
    for n in (40, 70, 200, 700):  # star-shaped rings are valid until a vertex is moved
        for moved in (False, True):
            ring = [(round(10**6 * (1 + 0.3 * rnd.random()) * math.cos(2 * math.pi * k / n)),
                     round(10**6 * (1 + 0.3 * rnd.random()) * math.sin(2 * math.pi * k / n))) for k in range(n)]
            if moved:
                ring[n // 3] = (-ring[n // 3][0], -ring[n // 3][1])
            rings.append(ring)
    rows = [(k, [(x / 1e7 + 1.5, y / 1e7 + 43.0) for x, y in ring]) for k, ring in enumerate(rings)]
    df = spark.createDataFrame(rows, "id long, coords array<struct<lon:double,lat:double>>").repartition(4)
    got = {r.id: r.ok for r in with_ring_validity(df, "coords", "ok").collect()}
    want = {k: _valid_ring(ring) for k, ring in enumerate(rings)}
    assert got == want and 20 < sum(want.values()) < 300


def test_invalid_areas_leave_and_open_ways_may_stay_lines(spark):
    pts = lambda *xy: [{"lon": x and 2 + x / 100, "lat": 48 + y / 100} for x, y in xy]
    park, road = {"leisure": "park"}, {"highway": "motorway"}
    rows = [("area", 1, park, pts((1, 1), (2, 1), (2, 2), (1, 2))), ("area", 2, park, pts((1, 1), (2, 2), (2, 1), (1, 2))),
            ("area", 3, park, pts((1, 1), (3, 1), (2, 2), (3, 3), (1, 3), (2, 2))), ("area", 4, park, pts((1, 1), (2, 1), (2, 2), (5, 2), (2, 2), (1, 2))),
            ("area", 5, park, pts((1, 1), (2, 1), (2, 2), (1, 2), (None, 2))), ("area", 6, park, pts((1, 1), (2, 1))),
            ("way", 7, road, pts((1, 1), (3, 1), (3, 2))), ("way", 8, road, pts((1, 1), (3, 1), (3, 2), (1, 1))),
            ("way", 9, road, pts((1, 1), (2, 2), (2, 1), (1, 2))), ("way", 10, road, []), ("way", 11, road, None)]
    df = spark.createDataFrame(rows, "kind string, id long, tags map<string,string>, coords array<struct<lon:double,lat:double>>")
    closed = {r.id: (r.x_proj, r.y_proj) for r in map_elements.extract_poi(df).collect()}
    opened = {r.id: (r.x_proj, r.y_proj) for r in map_elements.extract_poi(df, close_open_ways=False).collect()}
    assert sorted(closed) == sorted(opened) == [1, 7, 8, 9]
    assert closed[1] == opened[1] and closed[8] == opened[8] == closed[7]
    # The line's centroid lies nearer to the long leg's middle than the triangle's.
    a, b = (spatial.project(spark.createDataFrame([(2.02, 48.01)], "longitude double, latitude double")).first()[c] for c in ("x_proj", "y_proj"))
    assert math.dist(opened[7], (a, b)) < math.dist(closed[7], (a, b)) * 1.5 and opened[7] != closed[7]


def test_greedy_dedup_long_chain_in_one_scan(spark):
    """A chain of 1,000 points, some of it across block borders, in no round
    at all; the same in rounds for a group said to be too large."""
    rnd = random.Random(51)
    x = 0.0
    rows = []
    for k in range(1000):
        x += rnd.uniform(5, 24)
        rows.append((k if k % 3 else 5000 - k, "Chaine", x, 300 * math.sin(x / 900)))
    rows += [(9000 + k, "", 4000.0 * k, 0.0) for k in range(30)] + [(9100 + k, "", 4000.0 * k + 10, 0.0) for k in range(0, 30, 2)]
    df = spark.createDataFrame(rows, "ord long, name string, x_proj double, y_proj double")
    want = _sequential_greedy(rows, 25.0)
    assert sorted(r.ord for r in spatial.greedy_dedup(df, 25.0, max_rounds=0).collect()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_dedup_small_blocks_and_giant_groups(spark, monkeypatch, seed):
    monkeypatch.setattr(spatial, "LINK_BLOCK", 4)
    monkeypatch.setattr(spatial, "FOLD_BUCKET_POINTS", 20)
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["", "a", "b"]), rnd.uniform(-900, 900), rnd.uniform(-300, 300)) for k in range(400)]
    rows += [(400 + k, "b", 3000 + 20.0 * k, -40.0 * (k % 2)) for k in range(60)]
    df = spark.createDataFrame(rows, "ord long, name string, x_proj double, y_proj double")
    want = _sequential_greedy(rows, 25.0)
    assert sorted(r.ord for r in spatial.greedy_dedup(df, 25.0).collect()) == want
    assert sorted(r.ord for r in spatial.greedy_dedup(df, 25.0, fold_points=30).collect()) == want


def test_greedy_dedup_of_nothing(spark):
    df = spark.createDataFrame([], "ord long, name string, x_proj double, y_proj double")
    assert spatial.greedy_dedup(df).count() == 0


def test_dense_cell_is_split_and_others_are_not(spark):
    """Half of all points in one cell (a third at one place): equal to brute
    force; only the dense cell's POIs are repeated."""
    rnd = random.Random(61)
    pts = [(i, 10.0, 20.0) for i in range(200)] + [(200 + i, rnd.uniform(0, 99), rnd.uniform(0, 99)) for i in range(100)]
    pts += [(300 + k, x, y) for k, x, y in _points(300, 62)]
    pois = [("a", i, rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(150)] + [("a", 500 + i, 50.0 + i, 40.0) for i in range(30)]
    p_df = spark.createDataFrame(pts, "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame(pois, "category string, id long, x_proj double, y_proj double")
    radii = {"a": 100.0}
    kw = {"broadcast_bytes": 0, "cell_points": 50}
    got = {r.k: (r.nb_a, r.distance_min_a) for r in spatial.radius_features(p_df, poi_df, ["k"], ["a"], radii, **kw).collect()}
    want = _brute(pts, pois, radii)
    assert {k: n for k, (n, _) in got.items()} == {k: v["a"][0] for k, v in want.items()}
    rows = spatial._by_category(p_df, ["k"], ["a"], radii, "x_proj", "y_proj")
    rows = rows.withColumn("cx", F.floor(F.col("qx") / 100.0)).withColumn("cy", F.floor(F.col("qy") / 100.0))
    dense = [tuple(r) for r in spatial._dense_cells(rows, 50).collect()]
    assert dense == [("a", 0, 0, 7)] or (len(dense) == 1 and dense[0][:3] == ("a", 0, 0) and dense[0][3] >= 6)


def test_nearest_poi_meets_few_pairs(spark, monkeypatch):
    """A heap of 400 POIs within the radius of 200 points: settled in the
    finest grid that has one, with the brute-force result."""
    rnd = random.Random(71)
    pois = [("a", i, rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for i in range(400)] + [("a", 900, 9000.0, 0.0), ("a", 901, 9000.0, 0.0)]
    pts = [(k, rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for k in range(200)] + [(900, 6100.0, 0.0), (901, -9000.0, 0.0), (None, 2500.0, 0.0)]
    p_df = spark.createDataFrame(pts, "k long, x_proj double, y_proj double")
    poi_df = spark.createDataFrame(pois, "category string, id long, x_proj double, y_proj double")
    rows, plain = [], spatial._cell_pairs

    def counted(*args):
        out = plain(*args)
        rows.append(out.count())
        return out

    monkeypatch.setattr(spatial, "_cell_pairs", counted)
    got = {r.k: (r.poi_id, r.dist) for r in spatial.nearest_poi(p_df, poi_df, ["k"], ["a"], {"a": 3000.0}).collect()}
    want = {}
    for k, x, y in pts:
        near = min((math.sqrt((x - px) * (x - px) + (y - py) * (y - py)), i) for _, i, px, py in pois)
        if near[0] <= 3000.0:
            want[k] = (near[1], near[0])
    assert got == want and got[900][0] == 900 and None in got and 901 not in got
    assert len(rows) == 3 and sum(rows) < 0.1 * 200 * 400
