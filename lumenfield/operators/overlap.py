"""The exact area that boundaries share, by a plane sweep over their edges.

Edges are cut at the lines of a grid of square tiles with some dozens of edges each. Where a region is inside on a vertical grid line (the crossings of its
edges with the line, in order, say where) a vertical edge closes its parts on both sides, so that each tile can be swept alone. In a tile, bands between all
heights of vertices and crossings hold edges that don't cross: sorted by x, those of a region open and close its intervals by the even-odd rule, and what
intervals share, times the height, is area. Only intervals that lie over another one are compared; regions as such are never paired.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.functions.geo import equal_area
from lumenfield.sources.shared import stash

#: Edges of a tile, about.
PER_TILE = 64
#: A tile with more times that is a crowd.
CROWD = 8
TILE = ["tile_x", "tile_y"]


def projected(rings: DataFrame) -> DataFrame:
    """Rings in metres of an equal-area projection, from degrees."""

    def point(p: Column) -> Column:
        x, y = equal_area(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return rings.withColumn("ring", F.transform("ring", point))


def directed(rings: DataFrame) -> DataFrame:
    """``(province_code, x1, y1, x2, y2)`` of all edges, closing ones included, from the lower to the upper end (of level ones, from the left)."""
    bad = F.exists("ring", lambda p: F.coalesce(F.isnan(p["x"]) | F.isnan(p["y"]) | (F.abs(p["x"]) + F.abs(p["y"]) == float("inf")), F.lit(True)))
    checked = F.when(bad, F.raise_error(F.lit("a ring has a point without finite coordinates"))).otherwise(F.col("ring"))
    rows = rings.filter(F.size("ring") > 2).select("province_code", checked.alias("ring"))
    following = F.concat(F.slice("ring", F.lit(2), F.size("ring") - 1), F.slice("ring", 1, 1))
    ends = F.arrays_zip(F.col("ring").alias("a"), following.alias("b"))
    order = lambda p: F.struct(p["y"], p["x"])
    ends = F.transform(ends, lambda e: F.when(order(e["a"]) <= order(e["b"]), F.struct(e["a"], e["b"])).otherwise(F.struct(e["b"].alias("a"), e["a"].alias("b"))))
    out = rows.select("province_code", F.explode(ends).alias("e"))
    return out.select("province_code", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("x1 != x2 OR y1 != y2")


def across(u: Column | float) -> Column:
    """The height at which an edge meets the vertical line ``u``."""
    return F.when(F.col("u1") == u, F.col("v1")).when(F.col("u2") == u, F.col("v2")).otherwise(F.col("v1") + (u - F.col("u1")) * (F.col("v2") - F.col("v1")) / (F.col("u2") - F.col("u1")))


def along(v: Column, edge: str = "") -> Column:
    """Where an edge is at the height ``v``."""
    u1, v1, u2, v2 = (F.col(f"{edge}{c}") for c in ("u1", "v1", "u2", "v2"))
    return F.when(u1 == u2, u1).otherwise(u1 + (v - v1) * (u2 - u1) / (v2 - v1))


def tiled(edges: DataFrame, per_tile: int = PER_TILE) -> tuple[DataFrame, float]:
    """``(province_code, tile_x, tile_y, u1, v1, u2, v2, low, high)``: the parts of edges in each tile, in units of a tile, and the tile's size.

    ``low`` and ``high`` bound the part; the edge itself stays whole, so equal edges of neighbours stay equal to the last bit.
    """
    span = F.sum(F.abs(F.col("x2") - F.col("x1")) + F.col("y2") - F.col("y1")).alias("span")
    b = edges.agg(F.count("*").alias("n"), span, F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"), F.min("y1").alias("south"), F.max("y2").alias("north")).first()
    if not b["n"]:
        return edges.selectExpr("province_code", "1L tile_x", "1L tile_y", "x1 u1", "y1 v1", "x2 u2", "y2 v2", "y1 low", "y2 high").filter("false"), 1.0
    wide, tall = max(b["east"] - b["west"], 1e-9), max(b["north"] - b["south"], 1e-9)
    size = max(sqrt(wide * tall * per_tile / b["n"]), max(wide, tall) / 65536)
    # smaller where edges crowd, as long as that doesn't cut them into very many parts
    middle = lambda a, b, low, s: F.floor(((F.col(a) + F.col(b)) / 2 - low) / s)
    while b["span"] / (size / 2) < 4 * b["n"]:
        held = edges.groupBy(middle("x1", "x2", b["west"], size).alias("x"), middle("y1", "y2", b["south"], size).alias("y")).count()
        if held.agg(F.max("count").alias("m")).first()["m"] <= CROWD * per_tile:
            break
        size /= 2
    unit = lambda c, low: ((F.col(c) - low) / size)
    rows = edges.select("province_code", unit("x1", b["west"]).alias("u1"), unit("y1", b["south"]).alias("v1"), unit("x2", b["west"]).alias("u2"), unit("y2", b["south"]).alias("v2"))
    left, right = F.least("u1", "u2"), F.greatest("u1", "u2")
    first = F.floor(left)

    # parts of edges by columns of tiles: from one line to the next, or to an end
    last = F.greatest(F.ceil(right) - 1, first)
    cut = rows.withColumns({"left": left, "right": right}).withColumn("tile_x", F.explode(F.sequence(first, last)))
    a = across(F.greatest("left", F.col("tile_x").cast("double")))
    b_ = across(F.least("right", (F.col("tile_x") + 1).cast("double")))
    upright = F.col("u1") == F.col("u2")
    parts = cut.withColumns({"low": F.when(upright, F.col("v1")).otherwise(F.least(a, b_)), "high": F.when(upright, F.col("v2")).otherwise(F.greatest(a, b_))})
    columns = ["province_code", "tile_x", "u1", "v1", "u2", "v2", "low", "high"]

    # lines that an edge crosses or ends at from the left
    lines = rows.withColumn("line", F.explode(F.filter(F.sequence(first + 1, F.greatest(F.floor(right), first + 1)), lambda x: x <= right)))
    lines = lines.select("province_code", "line", across(F.col("line").cast("double")).alias("v"))
    w = Window.partitionBy("province_code", "line").orderBy("v")
    inside = lines.select("province_code", "line", "v", F.lead("v").over(w).alias("till"), F.row_number().over(w).alias("k")).filter("k % 2 = 1 AND till > v")
    u = F.col("line").cast("double")
    closing = inside.withColumn("tile_x", F.explode(F.array(F.col("line") - 1, F.col("line"))))
    closing = closing.select("province_code", "tile_x", u.alias("u1"), F.col("v").alias("v1"), u.alias("u2"), F.col("till").alias("v2"), F.col("v").alias("low"), F.col("till").alias("high"))

    every = parts.select(*columns).unionByName(closing.select(*columns)).filter("high > low")
    bottom = F.floor("low")
    every = every.withColumn("tile_y", F.explode(F.sequence(bottom, F.greatest(F.ceil("high") - 1, bottom))))
    every = every.withColumns({"low": F.greatest("low", F.col("tile_y").cast("double")), "high": F.least("high", (F.col("tile_y") + 1).cast("double"))})
    return every.filter("high > low"), size


def bands(parts: DataFrame) -> DataFrame:
    """``(tile_x, tile_y, base, top)``: heights of each tile between which no part begins, ends or crosses another."""
    here = F.struct("province_code", "u1", "v1", "u2", "v2").alias("of")
    a = parts.select(*TILE, here, *(F.col(c).alias(f"a_{c}") for c in ("u1", "v1", "u2", "v2", "low", "high")))
    b = parts.select(*TILE, here.alias("of_b"), *(F.col(c).alias(f"b_{c}") for c in ("u1", "v1", "u2", "v2", "low", "high")))
    low, high = F.greatest("a_low", "b_low"), F.least("a_high", "b_high")
    # only parts whose ranges of x and height meet
    reach = lambda f, e: f(F.col(f"{e}_u1"), F.col(f"{e}_u2"))
    near = (F.col("of") < F.col("of_b")) & (low < high) & (reach(F.least, "a") <= reach(F.greatest, "b")) & (reach(F.least, "b") <= reach(F.greatest, "a"))
    both = a.join(b, TILE).filter(near).withColumns({"low": low, "high": high})
    d1 = along(F.col("low"), "a_") - along(F.col("low"), "b_")
    d2 = along(F.col("high"), "a_") - along(F.col("high"), "b_")
    crossings = both.withColumns({"d1": d1, "d2": d2}).filter("(d1 < 0 AND d2 > 0) OR (d1 > 0 AND d2 < 0)")
    crossings = crossings.select(*TILE, (F.col("low") + (F.col("high") - F.col("low")) * F.col("d1") / (F.col("d1") - F.col("d2"))).alias("v"))
    ends = parts.select(*TILE, F.explode(F.array("low", "high")).alias("v"))
    w = Window.partitionBy(*TILE).orderBy("v")
    return ends.unionByName(crossings).distinct().select(*TILE, F.col("v").alias("base"), F.lead("v").over(w).alias("top")).filter("top > base")


def intervals(rings: DataFrame, per_tile: int = PER_TILE) -> tuple[DataFrame, float]:
    """``(province_code, tile_x, tile_y, base, top, a, b)``: where each region is inside, halfway up each band, in units of a tile; and the tile's size."""
    parts, size = tiled(stash(directed(rings), "edges"), per_tile)
    parts = stash(parts, "parts")
    held = parts.join(bands(parts), TILE).filter((F.col("low") <= F.col("base")) & (F.col("top") <= F.col("high")))
    held = held.withColumn("u", along((F.col("base") + F.col("top")) / 2))
    w = Window.partitionBy(*TILE, "base", "province_code").orderBy("u")
    out = held.select("province_code", *TILE, "base", "top", F.col("u").alias("a"), F.lead("u").over(w).alias("b"), F.row_number().over(w).alias("k"))
    return out.filter("k % 2 = 1 AND b > a").drop("k"), size


def overlaps(rings: DataFrame, minimum: float = 1.0, per_tile: int = PER_TILE) -> tuple[DataFrame, DataFrame]:
    """Pairs of regions that share more than ``minimum`` square metres, as ``(code_a, code_b, overlap_m2)``, and the audit of all in one row:
    ``(valid_count, area_km2, overlap_excess_km2, overlap_fraction)``.

    ``rings`` are in metres of an equal-area projection (``projected``). A region is what is inside an odd number of its rings, so holes and islands
    work, in any direction of turning. The excess is the sum of the regions' areas above the area of their union. Borders that only touch share nothing. Rings of
    under three points have no area; repeated rings of one region cancel out in pairs; a point without finite coordinates fails the job. An empty table gives no pair and an audit of zeros (fraction null).
    """
    made, size = intervals(rings, per_tile)
    band = [*TILE, "base"]
    w = Window.partitionBy(*band).orderBy("a", "b", "province_code")
    reached = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    made = stash(made.withColumns({"reached": reached, "next": F.lead("a").over(w)}), "intervals")
    area = (F.col("top") - F.col("base")) * size * size
    over = made.filter("reached > a OR next < b")
    one = over.select(*band, "top", F.col("province_code").alias("code_a"), F.col("a").alias("a1"), F.col("b").alias("b1"))
    two = over.select(*band, F.col("province_code").alias("code_b"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    shared = one.join(two, band).filter("code_a < code_b AND a1 < b2 AND a2 < b1")
    shared = shared.groupBy("code_a", "code_b").agg(F.sum(area * (F.least("b1", "b2") - F.greatest("a1", "a2"))).alias("overlap_m2"))
    whole = F.coalesce(F.sum(area * (F.col("b") - F.col("a"))), F.lit(0.0))
    union = F.coalesce(F.sum(area * F.greatest(F.col("b") - F.greatest("a", F.coalesce("reached", "a")), F.lit(0.0))), F.lit(0.0))
    audit = made.agg(F.countDistinct("province_code").alias("valid_count"), (whole / 1e6).alias("area_km2"), ((whole - union) / 1e6).alias("overlap_excess_km2"))
    return shared.filter(F.col("overlap_m2") > minimum), audit.withColumn("overlap_fraction", F.try_divide("overlap_excess_km2", "area_km2"))


def region_areas(rings: DataFrame, per_tile: int = PER_TILE) -> DataFrame:
    """``(province_code, area_km2)`` of regions with an area, by the same sweep."""
    made, size = intervals(rings, per_tile)
    return made.groupBy("province_code").agg((F.sum((F.col("top") - F.col("base")) * (F.col("b") - F.col("a"))) * size * size / 1e6).alias("area_km2"))
