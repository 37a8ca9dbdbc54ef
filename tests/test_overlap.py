"""Exact overlaps against a sweep in rational numbers over all edges at once."""

import random
from collections import defaultdict
from fractions import Fraction
from itertools import combinations
from math import cos, pi, sin

import pytest
from pyspark.sql import functions as F

from lumenfield.functions.geo import equal_area
from lumenfield.operators import overlap

SCHEMA = "province_code string, ring array<struct<x: double, y: double>>"


def exact(rings):
    """Shared areas of pairs, all areas, and the area of the union."""
    edges = []
    for code, ring in rings:
        if len(ring) > 2:
            points = [(Fraction(x), Fraction(y)) for x, y in ring]
            edges += [(code, *sorted((a, b), key=lambda p: p[1])) for a, b in zip(points, points[1:] + points[:1]) if a[1] != b[1]]
    at = lambda e, y: e[1][0] + (y - e[1][1]) * (e[2][0] - e[1][0]) / (e[2][1] - e[1][1])
    heights = {p[1] for e in edges for p in e[1:]}
    for e, f in combinations(edges, 2):
        low, high = max(e[1][1], f[1][1]), min(e[2][1], f[2][1])
        if low < high:
            d1, d2 = at(e, low) - at(f, low), at(e, high) - at(f, high)
            if d1 * d2 < 0:
                heights.add(low + (high - low) * d1 / (d1 - d2))
    heights = sorted(heights)
    pairs, areas, union = defaultdict(Fraction), defaultdict(Fraction), Fraction(0)
    for low, high in zip(heights, heights[1:]):
        crossing = sorted((at(e, (low + high) / 2), e[0]) for e in edges if e[1][1] <= low and e[2][1] >= high)
        inside = set()
        for (x, code), (after, _) in zip(crossing, [*crossing[1:], (None, None)]):
            inside ^= {code}
            if after is not None:
                area = (after - x) * (high - low)
                union += area * bool(inside)
                for c in inside:
                    areas[c] += area
                for pair in combinations(sorted(inside), 2):
                    pairs[pair] += area
    return {k: float(v) for k, v in pairs.items() if v}, {k: float(v) for k, v in areas.items() if v}, float(union)


def check(spark, rings, minimum=1e-6, per_tile=8):
    df = spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in r]) for c, r in rings], SCHEMA).withColumn("u1", F.lit("clash"))
    pairs, areas, union = exact(rings)
    shared, audit = overlap.overlaps(df, minimum, per_tile)
    got = {(r["code_a"], r["code_b"]): r["overlap_m2"] for r in shared.collect()}
    assert got == pytest.approx({k: v for k, v in pairs.items() if v > minimum}, rel=1e-9)
    row = audit.first()
    total = sum(areas.values())
    assert row["valid_count"] == len(areas)
    assert row["area_km2"] == pytest.approx(total / 1e6, rel=1e-9)
    assert row["overlap_excess_km2"] == pytest.approx((total - union) / 1e6, rel=1e-6, abs=1e-9 * max(total, 1) / 1e6)
    own = {r["province_code"]: r["area_km2"] * 1e6 for r in overlap.region_areas(df, per_tile).collect()}
    assert own == pytest.approx(areas, rel=1e-9)


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def test_squares_holes_and_touching_borders(spark):
    check(
        spark,
        [
            ("01", square(0, 0, 10)),
            ("01", square(2, 2, 4)[::-1]),  # a hole
            ("02", square(3, 3, 2)),  # wholly in the hole
            ("03", square(10, 0, 10)),  # touches 01 along a side
            ("04", square(8, 8, 4)),  # over a corner of 01 and of 03
            ("05", [(5, 10), (10, 10), (10, 5)]),  # inside 01 and over nothing but 01 and 04
            ("06", square(40, 40, 5)),  # an island far away
            ("06", square(50, 40, 5) + square(50, 40, 5)[:1]),  # closed explicitly
            ("07", [(0, 0), (1, 1)]),  # no area
        ],
        per_tile=4,
    )


def test_a_region_inside_another(spark):
    check(spark, [("01", square(0, 0, 1000)), ("02", square(400, 400, 10)), ("03", square(401, 401, 2))], per_tile=2)


def test_repeated_and_crossing_rings(spark):
    bow = [(0, 0), (10, 10), (10, 0), (0, 10)]
    check(spark, [("01", bow), ("02", square(1, 1, 8)), ("03", square(0, 0, 3)), ("03", square(0, 0, 3)), ("04", square(0, 0, 3))], per_tile=3)


@pytest.mark.parametrize("seed", range(3))
def test_random_regions(spark, seed):
    rng = random.Random(seed)
    rings = []
    for k in range(9):
        x, y = rng.uniform(0, 60), rng.uniform(0, 60)
        n = rng.randrange(3, 25)
        rings.append((f"{k:02}", [(x + rng.uniform(3, 20) * cos(2 * pi * i / n), y + rng.uniform(3, 20) * sin(2 * pi * i / n)) for i in range(n)]))
    rings += [("09", square(5, 5, 50)), ("09", square(10, 10, 5)), ("10", square(-3, 20, 90))]
    check(spark, rings, per_tile=rng.choice([3, 9, 200]))


def test_edges_that_crowd_in_one_place(spark):
    """Many small regions in a corner of a large map: tiles get smaller there, and the result stays."""
    rng = random.Random(12)
    rings = [("00", square(0, 0, 1000))] + [(f"{k:02}", [(x + rng.random(), y), (x + 1, y + rng.random()), (x + 0.2, y + 1), (x - 0.3, y + 0.5)]) for k, (x, y) in enumerate(((rng.uniform(1, 6), rng.uniform(1, 6)) for _ in range(40)), 1)]
    check(spark, rings, per_tile=2)
    df = spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in r]) for c, r in rings], SCHEMA)
    parts, size = overlap.tiled(overlap.directed(df), 2)
    assert size < 100 and parts.groupBy(*overlap.TILE).count().agg(F.max("count")).first()[0] < 164


def test_neighbours_with_a_common_border_share_nothing(spark):
    """A slanted border of many points, the same on both sides."""
    rng = random.Random(7)
    border = [(50 + rng.uniform(-9, 9), y * 3.7) for y in range(40)]
    left = [(0, border[0][1]), *border, (0, border[-1][1])]
    right = [(100, border[-1][1]), *border[::-1], (100, border[0][1])]
    df = spark.createDataFrame([("01", [{"x": float(x), "y": float(y)} for x, y in left]), ("02", [{"x": float(x), "y": float(y)} for x, y in right])], SCHEMA)
    shared, audit = overlap.overlaps(df, 0.0, 16)
    assert sum(r["overlap_m2"] for r in shared.collect()) < 1e-9
    assert abs(audit.first()["overlap_excess_km2"]) < 1e-12


def test_empty_table_and_bad_points(spark):
    shared, audit = overlap.overlaps(spark.createDataFrame([], SCHEMA))
    assert shared.count() == 0
    assert audit.first().asDict() == {"valid_count": 0, "area_km2": 0.0, "overlap_excess_km2": 0.0, "overlap_fraction": None}
    with pytest.raises(Exception, match="without finite coordinates"):
        overlap.overlaps(spark.createDataFrame([("01", [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": None}, {"x": 1.0, "y": 1.0}])], SCHEMA))


def test_equal_area_projection(spark):
    """The known corner of the global grid, and the area of the ellipsoid."""
    lon, lat = F.col("lon"), F.col("lat")
    df = spark.createDataFrame([(180.0, 85.0445664076212), (0.0, 0.0), (180.0, 90.0)], "lon double, lat double")
    rows = df.select(equal_area(lon, lat)[0].alias("x"), equal_area(lon, lat)[1].alias("y")).collect()
    assert rows[0]["x"] == pytest.approx(17367530.445, abs=0.01)
    assert rows[0]["y"] == pytest.approx(7314540.831, abs=0.01)
    assert (rows[1]["x"], rows[1]["y"]) == (0, 0)
    assert 4 * rows[2]["x"] * rows[2]["y"] == pytest.approx(510065621724088.4, rel=1e-9)
