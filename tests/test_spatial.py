import hashlib
import random
from math import hypot

import pytest
from pyspark.sql import functions as F

from lumenfield.operators import raster, spatial

RINGS = "province_code string, ring array<struct<x: double, y: double>>"


def rings_of(spark, shapes):
    return spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in r]) for c, r in shapes], RINGS).withColumn("piece", F.lit("clash"))


def pairs_of(df):
    return {(r["code_a"], r["code_b"]): r["shared_length"] for r in df.collect()}


def test_cells_against_their_neighbours(spark):
    rng = random.Random(3)
    code = {(r, c): f"{(r + rng.randrange(2)) // 3:02}{(c + rng.randrange(2)) // 4:02}" for r in range(12) for c in range(15)}
    want = {}
    for (r, c), a in code.items():
        for b in (code.get((r + 1, c)), code.get((r, c + 1))):
            if b is not None and a != b:
                key = min(a, b), max(a, b)
                want[key] = want.get(key, 0) + 1
    cells = spark.createDataFrame([(a, r, c) for (r, c), a in code.items()], "province_code string, row int, col int")
    assert pairs_of(spatial.neighbours(raster.rings_of_cells(cells))) == pytest.approx(want)


def test_slanted_borders_with_other_points(spark):
    """A border on one line that one side draws in one edge and the other in three, a corner contact, and an island."""
    shapes = [
        ("01", [(0, 0), (9, 6), (0, 6)]),
        ("02", [(0, 0), (3, 2), (6, 4), (9, 6), (9, 0)]),
        ("03", [(9, 6), (12, 6), (12, 9)]),  # touches the others in a point
        ("04", [(100, 100), (101, 100), (101, 101)]),
        ("05", [(3, 6), (6, 6), (6, 8), (3, 8)]),  # on part of the upper side of 01
        ("05", [(3, 6), (6, 6), (6, 8), (3, 8)]),  # repeated
        ("06", [(0, 0), (1, 1)]),
    ]
    assert pairs_of(spatial.neighbours(rings_of(spark, shapes))) == pytest.approx({("01", "02"): hypot(9, 6), ("01", "05"): 3.0})


def brute(values, pairs, permutations, seed):
    """Moran's I by its definition with a full matrix of weights."""
    x = {c: v for c, v in values.items() if v is not None}
    near = {c: sorted({b for a, b in [*pairs, *[p[::-1] for p in pairs]] if a == c and b in x}) for c in x}
    part = sorted(c for c in x if near[c])
    n = len(part)
    z = [x[c] - sum(x[k] for k in part) / n for c in part]
    w = [[(b in near[a]) / len(near[a]) for b in part] for a in part]
    stat = lambda z: n / sum(map(sum, w)) * sum(w[i][j] * z[i] * z[j] for i in range(n) for j in range(n)) / sum(v * v for v in z)
    runs = []
    for p in range(1, permutations + 1):
        order = sorted(part, key=lambda c: hashlib.md5(f"{seed}:{p}:{c}".encode()).hexdigest())
        runs.append(stat([z[order.index(c)] for c in part]))
    own = stat(z)
    return n, len(x) - n, len(values) - len(x), own, -1 / (n - 1), sum(runs) / len(runs), (1 + sum(r >= own - 1e-12 for r in runs)) / (permutations + 1)


COLUMNS = ("regions", "isolated", "missing", "moran_i", "expected", "mean_permuted", "pseudo_p")


def test_moran_against_its_definition(spark):
    rng = random.Random(4)
    grid = [(r, c) for r in range(5) for c in range(5)]
    name = lambda r, c: f"{r}{c}"
    pairs = [(name(r, c), name(*b)) for r, c in grid for b in ((r + 1, c), (r, c + 1)) if b in grid]
    smooth = {name(r, c): r * 2.0 + rng.random() for r, c in grid} | {"91": 4.0, "92": None}
    smooth["11"] = None
    noise = {name(r, c): rng.random() for r, c in grid}
    rows = [("smooth", c, v) for c, v in smooth.items()] + [("noise", c, v) for c, v in noise.items()] + [("flat", name(r, c), 0.1) for r, c in grid] + [("few", "00", 1.0), ("few", "01", 2.0), ("none", "00", None)]
    values = spark.createDataFrame(rows, "year string, province_code string, v double")
    links = spark.createDataFrame(pairs, "code_a string, code_b string")
    got = {r["year"]: tuple(r[c] for c in COLUMNS) for r in spatial.morans_i(values, links, "v", ["year"], 49, 7).collect()}
    assert got["smooth"] == pytest.approx(brute(smooth, pairs, 49, 7))
    assert got["noise"] == pytest.approx(brute(noise, pairs, 49, 7))
    assert got["smooth"][3] > 0.5 and got["smooth"][6] == 0.02
    assert got["flat"] == (25, 0, 0, None, None, None, None)
    assert got["few"] == (2, 0, 0, None, None, None, None)
    assert got["none"] == (0, 0, 1, None, None, None, None)
    # one seed, other partitions
    again = spatial.morans_i(values.repartition(7), links.repartition(3), "v", ["year"], 49, 7)
    for r in again.collect():
        assert tuple(r[c] for c in COLUMNS) == pytest.approx(got[r["year"]])
    other = spatial.morans_i(values.filter("year = 'noise'"), links, "v", permutations=49, seed=8).first()
    assert other["moran_i"] == pytest.approx(got["noise"][3])
    assert tuple(other[c] for c in COLUMNS) == pytest.approx(brute(noise, pairs, 49, 8))


def test_empty_tables(spark):
    links = spark.createDataFrame([], "code_a string, code_b string")
    assert spatial.morans_i(spark.createDataFrame([], "year int, province_code string, v double"), links, "v", ["year"]).count() == 0
    one = spatial.morans_i(spark.createDataFrame([(1, "01", 2.0)], "year int, province_code string, v double"), links, "v", ["year"], 9).first()
    assert (one["regions"], one["isolated"], one["moran_i"]) == (0, 1, None)
    assert spatial.neighbours(rings_of(spark, [])).count() == 0
