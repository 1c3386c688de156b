import math

import numpy as np
import pytest

from propspark.operators import point_links


def _brute(rows, t):
    """Pairs (earlier, later) of one name within t."""
    out = set()
    for i, (o, n, x, y) in enumerate(rows):
        for p, m, u, v in rows[:i]:
            if n is not None and n == m and math.sqrt((x - u) * (x - u) + (y - v) * (y - v)) <= t:
                out.add((min(o, p), max(o, p)))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "ord bigint, name string, x_proj double, y_proj double")


def _expanded(rows, members, links, t, levels):
    """All pairs that classes and links stand for."""
    place = {o: (n, x, y) for o, n, x, y in rows}
    cls = {r["ord"]: r["class_id"] for r in members}
    out = [tuple(sorted((a, b))) for a in cls for b in cls if a < b and cls[a] == cls[b]]

    def points(link, p):
        if link["level"] == levels:
            n, x, y = place[link[p]]
            return [o for o, at in place.items() if at == (n, x, y)]
        side = point_links.CELL * t / (1 << link["level"])
        cell = (link["nm"], link[p + "_fx"], link[p + "_fy"])
        return [o for o, (n, x, y) in place.items() if n is not None and (n, math.floor(x / side), math.floor(y / side)) == cell]

    for link in links:
        ends = points(link, "a"), points(link, "b")
        assert (len(ends[0]), len(ends[1])) == (link["n_a"], link["n_b"])
        assert (min(ends[0]), min(ends[1])) == (link["a"], link["b"])
        out += [tuple(sorted((a, b))) for a in ends[0] for b in ends[1]]
    return out


@pytest.mark.parametrize("levels,spread", [(4, 400.0), (1, 60.0), (2, 60.0), (4, 60.0)])
def test_links_expand_to_all_pairs(spark, levels, spread):
    rng = np.random.default_rng(int(spread) + levels)
    t = 30.0
    rows = [(i, ["a", "b", None][rng.integers(3)], float(x), float(y))
            for i, (x, y) in enumerate(rng.uniform(-spread, spread, (250, 2)).round(1))]
    rows += [(1000 + i, "a", 3.5, -2.0) for i in range(20)]  # one place
    rows += [(2000 + i, "c", 30.0 * i, 0.0) for i in range(5)]  # at the threshold exactly
    rows += [(3000, "a", float("nan"), 0.0), (3001, "a", None, 0.0), (3002, "a", float("inf"), 0.0)]
    members, links = point_links.same_name_links(_frame(spark, rows), t, levels=levels)
    got, links = members.collect(), links.collect()
    real = [r for r in rows if r[2] is not None and abs(r[2]) < math.inf]
    want = _brute(real, t)
    pairs = _expanded(real, [r for r in got if r["ord"] < 3000 and dict((o, n) for o, n, _, _ in real)[r["ord"]]], links, t, levels)
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == want
    count = {o: 0 for o, *_ in rows}
    for a, b in want:
        count[a] += 1
        count[b] += 1
    assert {r["ord"]: r["n_links"] for r in got} == count


def test_output_is_linear_on_dense_points(spark):
    """Two coincident crowds of 50,000 points: one class each, one link."""
    crowd = spark.range(100_000).selectExpr("id AS ord", "'n' AS name", "IF(id % 2 = 0, 1.0D, 25.0D) AS x_proj", "2.0D AS y_proj")
    members, links = point_links.same_name_links(crowd, 30.0)
    assert [(r["a"], r["b"], r["n_a"], r["n_b"]) for r in links.collect()] == [(0, 1, 50_000, 50_000)]
    assert members.groupBy("class_id", "n_links").count().count() == 2
    assert {r["n_links"] for r in members.select("n_links").distinct().collect()} == {99_999}


def test_links_of_dense_neighbour_cells_are_few(spark):
    """4,000 different places within two thresholds: boxes stand for most pairs."""
    rng = np.random.default_rng(3)
    rows = [(i, "a", float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 60, (4000, 2)))]
    members, links = point_links.same_name_links(_frame(spark, rows), 30.0, levels=5)
    xy = np.array([r[2:] for r in rows])
    near = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2)) <= 30.0
    got = {r["ord"]: r["n_links"] for r in members.collect()}
    assert [got[i] for i in range(4000)] == (near.sum(axis=1) - 1).tolist()
    assert links.count() < near.sum() / 2 / 5


def test_links_of_nothing(spark):
    members, links = point_links.same_name_links(_frame(spark, []), 30.0)
    assert members.collect() == [] and links.collect() == []
    with pytest.raises(ValueError):
        point_links.same_name_links(_frame(spark, []), 0.0)
