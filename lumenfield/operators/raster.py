"""Raster operators as joins and aggregations over a pixel table."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.functions.columns import is_valid
from lumenfield.functions.geo import to_degrees
from lumenfield.schemas import NODATA
from lumenfield.sources.shared import stash


def mosaic(pixel: DataFrame, order: str = "tile", keys: Sequence[str] = ()) -> DataFrame:
    """One value for each grid cell of each image set (``keys``): of the first tile, by ``order``, that has data there."""
    ok = pixel.filter(is_valid())
    return ok.groupBy(*keys, "row", "col").agg(F.min_by("radiation", order).alias("radiation"), F.min(order).alias("tile"))


def edges(rings: DataFrame) -> DataFrame:
    """``(province_code, x1, y1, x2, y2)`` of rings (``ARRAY<STRUCT<x, y>>``), closed if they aren't."""
    points = F.col("ring")
    following = F.concat(F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    pairs = F.explode(F.arrays_zip(points.alias("a"), following.alias("b"))).alias("e")
    out = rings.filter(F.size("ring") > 2).select("province_code", pairs)
    return out.select("province_code", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("y1 != y2")


def province_runs(edge_table: DataFrame, west: float, north: float, size: float, rows: int, cols: int) -> DataFrame:
    """``(province_code, row, start, stop)``: runs of the cells whose centre is inside, by scan lines and the even-odd rule, so holes work.

    Each edge is dealt to the rows whose centre lines it crosses; crossings of a row, in order, open and close runs of cells.
    Nothing is compared with all cells. Edges are half-open in y, runs in x, so touching regions don't share cells.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first = F.greatest(F.floor((F.lit(north) - high) / size - 0.5).cast("int"), F.lit(0))
    last = F.least(F.ceil((F.lit(north) - low) / size - 0.5).cast("int"), F.lit(rows - 1))
    lines = edge_table.withColumns({"low": low, "high": high, "first": first, "last": last}).filter("first <= last")
    lines = lines.withColumn("row", F.explode(F.sequence("first", "last")))
    y = F.lit(north) - (F.col("row") + 0.5) * size
    lines = lines.filter((y >= F.col("low")) & (y < F.col("high")))
    lines = lines.withColumn("x", F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    w = Window.partitionBy("province_code", "row").orderBy("x")
    runs = lines.select("province_code", "row", "x", F.lead("x").over(w).alias("end"), F.row_number().over(w).alias("k")).filter("k % 2 = 1 AND end IS NOT NULL")
    start = F.greatest(F.ceil((F.col("x") - west) / size - 0.5).cast("int"), F.lit(0))
    stop = F.least(F.ceil((F.col("end") - west) / size - 0.5).cast("int") - 1, F.lit(cols - 1))
    return runs.withColumns({"start": start, "stop": stop}).filter("start <= stop").select("province_code", "row", "start", "stop")


def assign_province(edge_table: DataFrame, west: float, north: float, size: float, rows: int, cols: int) -> DataFrame:
    """``(province_code, row, col)`` of the cells of ``province_runs``."""
    runs = province_runs(edge_table, west, north, size, rows, cols)
    return runs.select("province_code", "row", F.explode(F.sequence("start", "stop")).alias("col"))


#: Runs that go to every task, at most (some 20 bytes each), and the columns of a block where there are more.
MOST_RUNS, BLOCK_COLS = 500_000, 256


def clip(pixel: DataFrame, runs: DataFrame, most_runs: int = MOST_RUNS) -> DataFrame:
    """Pixels inside the runs of ``province_runs``, with their province; those outside of all are no rows, rather than zeros.

    The runs are counted: up to ``most_runs`` they go to the pixels, which then aren't shuffled; beyond, both are dealt by row and block of columns.
    A pixel inside several provinces is a row for each.
    """
    runs = stash(runs.select("province_code", F.col("row").alias("__row"), "start", "stop"), "runs")
    inside = F.col("col").between(F.col("start"), F.col("stop"))
    if runs.count() <= most_runs:
        return pixel.join(F.broadcast(runs), (F.col("row") == F.col("__row")) & inside).drop("__row", "start", "stop")
    block = lambda c: F.floor(F.col(c) / BLOCK_COLS)
    runs = runs.withColumn("__block", F.explode(F.sequence(block("start"), block("stop"))))
    return pixel.join(runs.hint("merge"), (F.col("row") == F.col("__row")) & (block("col") == F.col("__block")) & inside).drop("__row", "__block", "start", "stop")


def snapped_bounds(rings: DataFrame, west: float, north: float, size: float, rows: int, cols: int) -> DataFrame:
    """``(province_code, row_first, row_last, col_first, col_last, west, south, east, north)``: the extent of each province, out to whole cells of the grid and not beyond it.

    Bounds within a millionth of a cell of a grid line lie on it. A province outside of the grid is no row.
    """
    down = lambda v: F.floor(F.round(v, 6)).cast("int")
    up = lambda v: (F.ceil(F.round(v, 6)) - 1).cast("int")
    box = province_bbox(rings)
    out = box.select(
        "province_code", F.greatest(down((north - F.col("north")) / size), F.lit(0)).alias("row_first"), F.least(up((north - F.col("south")) / size), F.lit(rows - 1)).alias("row_last"),
        F.greatest(down((F.col("west") - west) / size), F.lit(0)).alias("col_first"), F.least(up((F.col("east") - west) / size), F.lit(cols - 1)).alias("col_last"),
    ).filter("row_first <= row_last AND col_first <= col_last")
    at = lambda c, k, zero, sign: (F.lit(zero) + sign * (F.col(c) + k) * size)
    return out.withColumns({"west": at("col_first", 0, west, 1), "south": at("row_last", 1, north, -1), "east": at("col_last", 1, west, 1), "north": at("row_first", 0, north, -1)})


def clip_raster(pixel: DataFrame, runs: DataFrame, bounds: DataFrame, wanted: DataFrame, keys: Sequence[str], nodata: float = NODATA, most_runs: int = MOST_RUNS) -> DataFrame:
    """Rasters of images cut to provinces, a row for each line: ``(*keys, province_code, row, col_first, values)``.

    ``wanted`` names the rasters: the image (``keys``) and the province. Each has all cells of the province's extent (``snapped_bounds``), whether or not the image has any pixel there;
    a cell that is outside of the boundary, masked or without a value is ``nodata``, and never 0 for lack of one. Of several observations of a cell the greatest counts. Pixels meet
    the runs as in ``clip``; what is shuffled after that are the valid cells inside the provinces that are wanted.
    """
    wanted = wanted.select(*keys, "province_code").distinct()
    asked = runs.join(wanted.select("province_code").distinct(), "province_code", "left_semi")
    ok = pixel.filter(is_valid()).select(*keys, "row", "col", "radiation")
    cells = clip(ok, asked, most_runs).groupBy(*keys, "province_code", "row", "col").agg(F.max("radiation").alias("v"))
    lines = cells.groupBy(*keys, "province_code", "row").agg(F.sort_array(F.collect_list(F.struct("col", "v"))).alias("cells"))
    frame = wanted.join(bounds.select("province_code", "row_first", "row_last", "col_first", "col_last"), "province_code")
    frame = frame.select(*keys, "province_code", F.explode(F.sequence("row_first", "row_last")).alias("row"), "col_first", "col_last")
    out = frame.join(lines, [*keys, "province_code", "row"], "left")
    # each cell after the gap before it, then the gap at the end
    gap = lambda n: F.array_repeat(F.lit(float(nodata)), n)
    before = lambda i: F.when(i == 0, F.col("col_first") - 1).otherwise(F.get("cells", i - 1)["col"])
    filled = F.flatten(F.transform("cells", lambda c, i: F.concat(gap(c["col"] - before(i) - 1), F.array(c["v"]))))
    rest = F.col("col_last") - F.element_at("cells", -1)["col"]
    values = F.when(F.col("cells").isNull(), gap(F.col("col_last") - F.col("col_first") + 1)).otherwise(F.concat(filled, gap(rest)))
    return out.select(*keys, "province_code", "row", "col_first", values.alias("values"))


def overlap_audit(grid_province: DataFrame, area: DataFrame) -> DataFrame:
    """Pairs of provinces that share cells, and the area that they share; ``area`` has ``row, col, pixel_area_km2``."""
    shared = grid_province.groupBy("row", "col").agg(F.array_sort(F.collect_set("province_code")).alias("codes")).filter(F.size("codes") > 1)
    pairs = shared.select("row", "col", F.posexplode("codes").alias("i", "code_a"), "codes")
    pairs = pairs.select("row", "col", "code_a", F.explode(F.slice("codes", F.col("i") + 2, F.size("codes"))).alias("code_b"))
    return pairs.join(area.select("row", "col", "pixel_area_km2"), ["row", "col"]).groupBy("code_a", "code_b").agg(F.count("*").alias("cells"), F.round(F.sum("pixel_area_km2"), 6).alias("area_km2"))


def image_extent(pixel: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Bounds of each image of a geographic grid: half a pixel beyond the outermost centres, to six digits."""
    half = size / 2
    bound = lambda f, c, d: F.round(f(c) + d, 6)
    return pixel.groupBy(*keys).agg(bound(F.min, "lon", -half).alias("west"), bound(F.min, "lat", -half).alias("south"), bound(F.max, "lon", half).alias("east"), bound(F.max, "lat", half).alias("north"))


def projected_extent(images: DataFrame, keys: Sequence[str], points: int = 21) -> DataFrame:
    """``(*keys, west, south, east, north)`` in degrees, to six digits, of images on any supported grid.

    ``images`` has ``crs_epsg``, the upper left corner ``left, top``, ``pixel_width, pixel_height`` (either sign) and ``rows, cols``. A straight edge of a projected grid is bent in degrees, so
    each edge is taken at ``points`` places besides its beginning. Without a CRS all bounds are null, as they are if a number is missing. Across the date line bounds go on past 180.
    """
    right = F.col("left") + F.abs("pixel_width") * F.col("cols")
    bottom = F.col("top") - F.abs("pixel_height") * F.col("rows")
    steps = F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: i / F.lit(float(points)))
    edges = F.flatten(F.transform(steps, lambda t: F.array(
        F.struct((F.col("left") + t * (right - F.col("left"))).alias("x"), F.col("top").cast("double").alias("y")), F.struct((F.col("left") + t * (right - F.col("left"))).alias("x"), bottom.cast("double").alias("y")),
        F.struct(F.col("left").cast("double").alias("x"), (F.col("top") + t * (bottom - F.col("top"))).alias("y")), F.struct(right.cast("double").alias("x"), (F.col("top") + t * (bottom - F.col("top"))).alias("y")))))
    known = F.col("left").isNotNull() & F.col("top").isNotNull() & right.isNotNull() & bottom.isNotNull()
    placed = images.select(*keys, F.transform(F.when(known, edges), lambda p: to_degrees(p["x"], p["y"], F.col("crs_epsg"))).alias("p"))
    bound = lambda f, c: F.round(f(f"p.{c}"), 6)
    return placed.select(*keys, bound(F.array_min, "lon").alias("west"), bound(F.array_min, "lat").alias("south"), bound(F.array_max, "lon").alias("east"), bound(F.array_max, "lat").alias("north"))


def province_bbox(rings: DataFrame) -> DataFrame:
    """Bounds of each province's vertices."""
    p = rings.select("province_code", F.explode("ring").alias("p"))
    return p.groupBy("province_code").agg(F.min("p.x").alias("west"), F.min("p.y").alias("south"), F.max("p.x").alias("east"), F.max("p.y").alias("north"))


def all_bbox(rings: DataFrame) -> DataFrame:
    return province_bbox(rings).agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def rings_of_cells(cells: DataFrame) -> DataFrame:
    """``(province_code, ring)``: a closed ring around each run of neighbouring cells in a row (``province_code, row, col``), with rows going down from 0."""
    w = Window.partitionBy("province_code", "row").orderBy("col")
    runs = cells.select("province_code", "row", "col").distinct().withColumn("run", F.col("col") - F.row_number().over(w))
    runs = runs.groupBy("province_code", "row", "run").agg(F.min("col").alias("first"), (F.max("col") + 1).alias("last"))
    point = lambda x, y: F.struct(x.cast("double").alias("x"), (-y).cast("double").alias("y"))
    top, low, left, right = F.col("row"), F.col("row") + 1, F.col("first"), F.col("last")
    return runs.select("province_code", F.array(point(left, top), point(right, top), point(right, low), point(left, low), point(left, top)).alias("ring"))


def boundary_stats(rings: DataFrame) -> DataFrame:
    """Rings and vertices of each province, most complex first."""
    return rings.groupBy("province_code").agg(F.count("*").alias("rings"), F.sum(F.size("ring")).alias("vertices")).orderBy(F.desc("vertices"), "province_code")


def most_complex(rings: DataFrame, n: int = 5) -> DataFrame:
    return boundary_stats(rings).limit(n)


def code_mismatch(rings: DataFrame, provinces: DataFrame, n: int = 10) -> DataFrame:
    """Codes of the boundary file that the catalogue lacks and the other way round, at most ``n`` of each, sorted."""
    file, known = rings.select("province_code").distinct(), provinces.select("province_code").distinct()
    extra = file.join(known, "province_code", "left_anti").orderBy("province_code").limit(n).withColumn("problem", F.lit("not in catalogue"))
    return extra.unionByName(known.join(file, "province_code", "left_anti").orderBy("province_code").limit(n).withColumn("problem", F.lit("not in file")))


def overview(pixel: DataFrame, factors: Sequence[int] = (2, 4, 8, 16, 32), keys: Sequence[str] = ()) -> DataFrame:
    """Average of the valid pixels of each ``factor`` x ``factor`` block, for all factors and each image (``keys``).

    Pixels are aggregated once, to sums and counts of the blocks that all factors are made of (their greatest common divisor);
    what is repeated for each factor are these blocks.
    """
    step = gcd(*factors)
    block = lambda c, k: F.floor(F.col(c) / k).cast("int").alias(c)
    fine = pixel.filter(is_valid()).groupBy(*keys, block("row", step), block("col", step)).agg(F.sum("radiation").alias("sum"), F.count("*").alias("n"))
    rows = fine.withColumn("factor", F.explode(F.array(*(F.lit(f) for f in factors))))
    k = F.col("factor") / step
    out = rows.groupBy(*keys, "factor", block("row", k), block("col", k)).agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    return out.select(*keys, "factor", "row", "col", F.round(F.col("sum") / F.col("n"), 6).alias("radiation"), "n")


def rgb_quicklook(pixel: DataFrame, factor: int, top: float = 3000.0) -> DataFrame:
    """Bands 3, 2, 1 averaged over blocks and scaled from 0..``top`` to bytes; ``pixel`` has ``row, col, band, radiation, mask``."""
    block = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    byte = F.least(F.greatest(F.floor(F.avg("radiation") * 255 / top + 0.5), F.lit(0)), F.lit(255)).cast("int")
    out = pixel.filter(is_valid() & F.col("band").isin(1, 2, 3)).groupBy(block("row"), block("col")).pivot("band", [3, 2, 1]).agg(byte)
    return out.select("row", "col", F.col("3").alias("red"), F.col("2").alias("green"), F.col("1").alias("blue"))
