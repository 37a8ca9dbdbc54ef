import random

import pytest
from pyspark.sql import functions as F

from lumenfield.operators import raster

RINGS = "province_code string, ring array<struct<x: double, y: double>>"
PIXEL = "image string, row int, col int, radiation double, mask boolean"


def rings_of(spark, shapes):
    return spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in r]) for c, r in shapes], RINGS)


def cut(spark, rings, pixel, wanted, grid, **more):
    lines = raster.clip_raster(pixel, raster.province_runs(raster.edges(rings), *grid), raster.snapped_bounds(rings, *grid), wanted, ["image"], **more).collect()
    return {(r["image"], r["province_code"], r["row"]): (r["col_first"], r["values"]) for r in lines}


def test_a_square_of_a_flat_image(spark):
    """20 x 20 cells of 5.0, 0.1 degrees, from 105 E and 22 N; a square from 105.1 to 105.5 and from 21.5 to 21.9."""
    rings = rings_of(spark, [("01", [(105.1, 21.9), (105.5, 21.9), (105.5, 21.5), (105.1, 21.5), (105.1, 21.9)])])
    grid = (105.0, 22.0, 0.1, 20, 20)
    pixel = spark.createDataFrame([("a", r, c, 5.0, True) for r in range(20) for c in range(20)], PIXEL)
    box = raster.snapped_bounds(rings, *grid).first()
    assert (box["row_first"], box["row_last"], box["col_first"], box["col_last"]) == (1, 4, 1, 4)
    assert (box["west"], box["south"], box["east"], box["north"]) == pytest.approx((105.1, 21.5, 105.5, 21.9))
    got = cut(spark, rings, pixel, spark.createDataFrame([("a", "01")], "image string, province_code string"), grid)
    assert got == {("a", "01", r): (1, [5.0] * 4) for r in range(1, 5)}


def inside(rings, x, y):
    """Even-odd by a ray to the left."""
    hit = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
                hit = not hit
    return hit


def test_every_cell_of_the_extent_is_there(spark):
    rng = random.Random(6)
    shapes = [("01", [(1.2, 1.1), (8.7, 2.3), (5.1, 9.4)]), ("01", [(4.1, 3.2), (5.9, 3.3), (5.2, 5.1)]), ("02", [(6.3, 0.4), (11.8, 1.2), (11.2, 6.6), (7.7, 7.1)]), ("03", [(-3.0, 8.2), (2.4, 8.3), (2.2, 14.0)]), ("04", [(50, 50), (51, 50), (51, 51)])]
    size, rows, cols = 0.5, 20, 24
    grid = (0.0, 10.0, size, rows, cols)
    cells = {}
    for image in "ab":
        for r in range(rows):
            for c in range(cols):
                if rng.random() < 0.8:
                    cells[image, r, c] = rng.choice([0.0, 1.5, None, float("nan"), -9999.0, rng.random()]), rng.random() < 0.9
    data = [(*k, *v) for k, v in cells.items()]
    data += [(i, r, c, (v or 0.0) - 1, True) for (i, r, c), (v, ok) in cells.items() if ok and v is not None and v == v and v >= 0]  # seen twice
    pixel = spark.createDataFrame(data, PIXEL).withColumns({"start": F.lit("clash"), "v": F.lit("clash"), "province_code": F.lit("99")}).drop("province_code")
    wanted = [(i, p) for i in ("a", "b", "c") for p in ("01", "02", "03", "04")]
    want = {}
    for image, code in wanted:
        own = [r for c, r in shapes if c == code]
        xs, ys = [x for r in own for x, _ in r], [y for r in own for _, y in r]
        c1, c2 = max(int(min(xs) // size), 0), min(-int(-max(xs) // size) - 1, cols - 1)
        r1, r2 = max(int((10 - max(ys)) // size), 0), min(-int(-(10 - min(ys)) // size) - 1, rows - 1)
        for r in range(r1, r2 + 1):
            line = []
            for c in range(c1, c2 + 1):
                v, ok = cells.get((image, r, c), (None, False))
                good = ok and v is not None and v == v and v != -9999.0
                line.append(v if good and inside(own, (c + 0.5) * size, 10 - (r + 0.5) * size) else -9999.0)
            if line:
                want[image, code, r] = (c1, line)
    asked = spark.createDataFrame(wanted, "image string, province_code string")
    rings = rings_of(spark, shapes)
    assert cut(spark, rings, pixel, asked, grid) == want
    assert cut(spark, rings, pixel, asked, grid, most_runs=0) == want
    assert cut(spark, rings, pixel.filter("false"), asked, grid) == {k: (c, [-9999.0] * len(v)) for k, (c, v) in want.items()}


def test_pixels_are_not_shuffled(spark, tmp_path):
    rings = rings_of(spark, [("01", [(1, 1), (8, 2), (5, 9)])])
    spark.range(1000).selectExpr("'a' AS image", "CAST(id % 10 AS INT) AS row", "CAST(id % 7 AS INT) AS col", "1.0 AS radiation", "true AS mask").write.parquet(str(tmp_path / "pixel"))
    pixel = spark.read.parquet(str(tmp_path / "pixel"))
    runs = raster.province_runs(raster.edges(rings), 0.0, 10.0, 1.0, 10, 10)
    plan = raster.clip(pixel, runs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    dealt = raster.clip(pixel, runs, most_runs=0)
    assert "SortMergeJoin" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, raster.clip(pixel, runs).collect()))
