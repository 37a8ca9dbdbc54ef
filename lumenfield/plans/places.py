"""Registered queries on boundaries and places, on shapes that the given tables draw."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfield.functions import geo
from lumenfield.operators import overlap, raster, spatial
from lumenfield.plans import sql as S
from lumenfield.plans.base import query
from lumenfield.sources import adapter as A

#: Sixteen directions, as whole numbers so that both engines place the same points.
DIRECTIONS = ((8, 0), (7, 3), (6, 6), (3, 7), (0, 8), (-3, 7), (-6, 6), (-7, 3), (-8, 0), (-7, -3), (-6, -6), (-3, -7), (0, -8), (3, -7), (6, -6), (7, -3))


def stars(spark, d):
    """A star for each nation, whose points reach as far as its customers' balances, and a hole in every second one; in degrees."""
    customer = A.table(spark, d, "customer")
    k, n = F.pmod("c_custkey", F.lit(16)).cast("int"), F.col("c_nationkey")
    reach = F.sum(F.round(F.col("c_acctbal") * 100).cast("long")) / F.count("*")
    rows = customer.groupBy("c_nationkey", k.alias("k")).agg(reach.alias("reach")).withColumn("reach", 0.3 + F.col("reach") / 2500000)
    way = F.element_at(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in DIRECTIONS)), F.col("k") + 1)
    x, y = 104 + n % 5 * 0.8, 9 + F.floor(n / 5) * 0.8
    rows = rows.withColumn("way", way).withColumn("scale", F.explode(F.when(n % 2 == 0, F.array(F.lit(8.0), F.lit(32.0))).otherwise(F.array(F.lit(8.0)))))
    point = F.struct("k", (x + F.col("reach") * F.col("way.x") / F.col("scale")).alias("x"), (y + F.col("reach") * F.col("way.y") / F.col("scale")).alias("y"))
    rings = rows.groupBy(F.lpad(n.cast("string"), 2, "0").alias("province_code"), "scale").agg(F.sort_array(F.collect_list(point)).alias("p"))
    return rings.select("province_code", F.transform("p", lambda p: F.struct(p["x"], p["y"])).alias("ring"))


_WAYS = ", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(DIRECTIONS))
#: The same by one sweep over all edges at once: every edge against every other, every band across the whole map.
SWEEP = f"""WITH ways(k, dx, dy) AS (VALUES {_WAYS}),
    reach AS (SELECT c_nationkey AS n, c_custkey % 16 AS k, 0.3::DOUBLE + sum(CAST(round(c_acctbal * 100) AS BIGINT))::DOUBLE / count(*) / 2500000 AS reach FROM customer GROUP BY ALL),
    points AS (SELECT n, k, scale, radians(104 + n % 5 * 0.8::DOUBLE + reach * dx / scale) AS lon, radians(9 + n // 5 * 0.8::DOUBLE + reach * dy / scale) AS lat
        FROM reach JOIN ways USING (k) JOIN (VALUES (8.0::DOUBLE), (32.0::DOUBLE)) s(scale) ON scale = 8 OR n % 2 = 0),
    metres AS (SELECT n, k, scale, lon * {geo.MAJOR * geo.K0!r} AS x,
        {geo.MAJOR / (2 * geo.K0)!r} * {1 - geo.E2!r} * (sin(lat) / (1 - {geo.E2!r} * sin(lat) * sin(lat)) - ln((1 - {geo.E!r} * sin(lat)) / (1 + {geo.E!r} * sin(lat))) / {2 * geo.E!r}) AS y FROM points),
    drawn AS (SELECT n, x AS xa, y AS ya, coalesce(lead(x) OVER w, first_value(x) OVER w) AS xb, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yb FROM metres
        WINDOW w AS (PARTITION BY n, scale ORDER BY k)),
    e AS (SELECT row_number() OVER () AS id, n, CASE WHEN ya < yb THEN xa ELSE xb END AS x1, least(ya, yb) AS y1, CASE WHEN ya < yb THEN xb ELSE xa END AS x2, greatest(ya, yb) AS y2 FROM drawn WHERE ya <> yb),
    met AS (SELECT greatest(a.y1, b.y1) AS lo, least(a.y2, b.y2) AS hi, a.x1 AS ax, a.y1 AS ay, (a.x2 - a.x1) / (a.y2 - a.y1) AS am, b.x1 AS bx, b.y1 AS by_, (b.x2 - b.x1) / (b.y2 - b.y1) AS bm
        FROM e a JOIN e b ON a.id < b.id AND a.y1 < b.y2 AND b.y1 < a.y2),
    crossed AS (SELECT lo, hi, ax + (lo - ay) * am - bx - (lo - by_) * bm AS d1, ax + (hi - ay) * am - bx - (hi - by_) * bm AS d2 FROM met),
    heights AS (SELECT y1 AS y FROM e UNION SELECT y2 FROM e UNION SELECT lo + (hi - lo) * d1 / (d1 - d2) FROM crossed WHERE d1 * d2 < 0),
    bands AS (SELECT y AS lo, lead(y) OVER (ORDER BY y) AS hi FROM heights),
    across AS (SELECT lo, hi, n, x1 + ((lo + hi) / 2 - y1) * (x2 - x1) / (y2 - y1) AS x FROM bands JOIN e ON y1 <= lo AND hi <= y2),
    runs AS (SELECT lo, hi, n, x AS a, lead(x) OVER w AS b, row_number() OVER w AS k FROM across WINDOW w AS (PARTITION BY lo, n ORDER BY x)),
    inside AS (SELECT * FROM runs WHERE k % 2 = 1 AND b > a)"""


@query(f"""{SWEEP} SELECT lpad(CAST(p.n AS VARCHAR), 2, '0') AS code_a, lpad(CAST(q.n AS VARCHAR), 2, '0') AS code_b, round(sum((p.hi - p.lo) * (least(p.b, q.b) - greatest(p.a, q.a))) / 1e6, 6) AS overlap_km2
    FROM inside p JOIN inside q ON p.lo = q.lo AND p.n < q.n AND p.a < q.b AND q.a < p.b GROUP BY ALL HAVING sum((p.hi - p.lo) * (least(p.b, q.b) - greatest(p.a, q.a))) > 1""")
def boundary_overlaps(spark, d):
    """Pairs of boundaries that share more than a square metre, and how much."""
    pairs, _ = overlap.overlaps(overlap.projected(stars(spark, d)))
    return pairs.select("code_a", "code_b", F.round(F.col("overlap_m2") / 1e6, 6).alias("overlap_km2"))


@query(f"""{SWEEP}, u AS (SELECT *, max(b) OVER (PARTITION BY lo ORDER BY a, b, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM inside),
    t AS (SELECT count(DISTINCT n) AS valid_count, sum((hi - lo) * (b - a)) / 1e6 AS area, sum((hi - lo) * greatest(b - greatest(a, coalesce(reached, a)), 0)) / 1e6 AS united FROM u)
    SELECT valid_count, round(area, 6) AS area_km2, round(area - united, 6) AS overlap_excess_km2, round((area - united) / area, 9) AS overlap_fraction FROM t""")
def boundary_audit(spark, d):
    """How much area all boundaries count more than once."""
    _, audit = overlap.overlaps(overlap.projected(stars(spark, d)))
    return audit.select("valid_count", *(F.round(c, 9 if c == "overlap_fraction" else 6).alias(c) for c in ("area_km2", "overlap_excess_km2", "overlap_fraction")))


def region_cells(spark, d):
    """``(province_code, row, col, radiation by year)``: the grid in 64 regions of some 8 x 8 cells, whose borders the numbers of observations of the cells move up and down."""
    rows = A.pixels(spark, d).filter("source = 'VIIRS'")
    cells = rows.groupBy("row", "col").agg(F.count("*").alias("n"))
    code = F.floor(F.least(F.col("row") + F.col("n") % 3, F.lit(63)) / 8) * 8 + F.floor(F.col("col") / 8)
    return cells.select(F.lpad(code.cast("string"), 2, "0").alias("province_code"), "row", "col")


REGIONS = f"""{S.PIXELS}, region AS (SELECT "row", col, lpad(CAST(least("row" + count(*) % 3, 63) // 8 * 8 + col // 8 AS VARCHAR), 2, '0') AS code FROM pixel WHERE source = 'VIIRS' GROUP BY "row", col),
    sides AS (SELECT a.code AS a, b.code AS b FROM region a JOIN region b ON (b."row" = a."row" + 1 AND b.col = a.col) OR (b."row" = a."row" AND b.col = a.col + 1) WHERE a.code <> b.code),
    pairs AS (SELECT least(a, b) AS code_a, greatest(a, b) AS code_b, CAST(count(*) AS DOUBLE) AS shared_length FROM sides GROUP BY ALL)"""


@query(f"{REGIONS} SELECT * FROM pairs")
def region_neighbours(spark, d):
    """Which regions share a border and how long it is, from the rings around their cells."""
    return spatial.neighbours(raster.rings_of_cells(region_cells(spark, d)))


RUNS = 99


@query(f"""{REGIONS}, x AS (SELECT year, code, sum(radiation) FILTER (mask) AS x FROM pixel JOIN region USING ("row", col) WHERE source = 'VIIRS' GROUP BY ALL),
    v AS (SELECT year, code, CASE WHEN code NOT IN ('07', '21') OR year % 2 = 0 THEN x END AS x FROM x), both_ AS (SELECT code_a AS a, code_b AS b FROM pairs UNION ALL SELECT code_b, code_a FROM pairs),
    links AS (SELECT p.year, a, b FROM both_ JOIN v p ON p.code = a AND p.x IS NOT NULL JOIN v q ON q.code = b AND q.year = p.year AND q.x IS NOT NULL),
    deg AS (SELECT year, a AS code, count(*) AS degree FROM links GROUP BY ALL),
    part AS (SELECT year, code, degree, x - avg(x) OVER (PARTITION BY year) AS z, row_number() OVER (PARTITION BY year ORDER BY code) AS place FROM v JOIN deg USING (year, code)),
    drawn AS (SELECT year, code, degree, run, CASE WHEN run = 0 THEN place ELSE row_number() OVER (PARTITION BY year, run ORDER BY md5('11:' || run || ':' || code)) END AS place FROM part CROSS JOIN range({RUNS + 1}) r(run)),
    dealt AS (SELECT d.year, d.run, d.code, d.degree, p.z FROM drawn d JOIN part p ON p.year = d.year AND p.place = d.place),
    runs AS (SELECT i.year, i.run, sum(i.z * j.z / i.degree) AS c FROM dealt i JOIN links ON links.year = i.year AND links.a = i.code JOIN dealt j ON j.year = i.year AND j.run = i.run AND j.code = links.b GROUP BY ALL),
    own AS (SELECT year, max(c) FILTER (run = 0) AS seen FROM runs GROUP BY year), sq AS (SELECT year, count(*) AS n, sum(z * z) AS s FROM part GROUP BY year)
    SELECT year, n AS regions, (SELECT count(x) FROM v WHERE v.year = sq.year) - n AS isolated, (SELECT count(*) FROM v WHERE v.year = sq.year AND x IS NULL) AS missing, round(seen / s, 9) AS moran_i, round(-1 / (n - 1), 9) AS expected,
        (SELECT count(*) FROM runs WHERE runs.year = sq.year AND c >= seen - 1e-12 * s) / {RUNS + 1}.0::DOUBLE AS pseudo_p FROM sq JOIN own USING (year)""")
def morans_i(spark, d):
    """Whether neighbouring regions are alike in light, for each year; two regions have no value in odd years."""
    cells = region_cells(spark, d)
    light = A.pixels(spark, d).filter("source = 'VIIRS'").drop("province_code").join(cells, ["row", "col"]).groupBy("year", "province_code").agg(F.sum(F.when(F.col("mask"), F.col("radiation"))).alias("light"))
    known = F.when(~F.col("province_code").isin("07", "21") | (F.col("year") % 2 == 0), F.col("light"))
    out = spatial.morans_i(light.withColumn("light", known), spatial.neighbours(raster.rings_of_cells(cells)), "light", ["year"], RUNS, 11)
    return out.select("year", "regions", "isolated", "missing", F.round("moran_i", 9).alias("moran_i"), F.round("expected", 9).alias("expected"), "pseudo_p")


def footprints(spark, d):
    """An image a nation and year of shipments, as large as their number says: in UTM of the north or south, in degrees, or without a CRS."""
    line, supplier = A.table(spark, d, "lineitem"), A.table(spark, d, "supplier")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("n"), F.year("l_shipdate").alias("y")).agg(F.count("*").alias("k"))
    kind = F.col("n") % 4
    by = lambda a, b: F.when(kind == 2, a).otherwise(b)
    return rows.select(
        F.lpad(F.col("n").cast("string"), 2, "0").alias("province_code"), F.col("y").alias("year"), F.when(kind == 0, 32648).when(kind == 1, 32749).when(kind == 2, 4326).alias("crs_epsg"),
        by(F.lit(102.0) + F.col("k") % 5, 250000.0 + F.col("k") * 137 % 300000).alias("left"), by(F.lit(23.0), 1000000.0 + F.col("k") * 911 % 1500000).alias("top"),
        by(F.lit(0.004), F.lit(463.83)).alias("pixel_width"), by(F.lit(-0.004), F.lit(-463.83)).alias("pixel_height"), (F.col("k") % 200 + 300).alias("cols"), F.lit(400).alias("rows"),
    )


def _series(name: str, coefficients: tuple[float, ...], a: str, b: str | None, one: str, two: str) -> str:
    return " + ".join(f"{c!r}::DOUBLE * {one}({2 * (j + 1)} * {a})" + (f" * {two}({2 * (j + 1)} * {b})" if b else "") for j, c in enumerate(coefficients))


_SCALE = repr(geo.UTM_SCALE * geo.RECTIFYING)


@query(f"""WITH k AS (SELECT s_nationkey AS n, year(l_shipdate) AS y, count(*) AS k FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
    images AS (SELECT lpad(CAST(n AS VARCHAR), 2, '0') AS province_code, y AS year, CASE n % 4 WHEN 0 THEN 32648 WHEN 1 THEN 32749 WHEN 2 THEN 4326 END AS epsg,
        (CASE n % 4 WHEN 2 THEN 102 + k % 5 ELSE 250000 + k * 137 % 300000 END)::DOUBLE AS l, (CASE n % 4 WHEN 2 THEN 23 ELSE 1000000 + k * 911 % 1500000 END)::DOUBLE AS t,
        (CASE n % 4 WHEN 2 THEN 0.004 ELSE 463.83 END)::DOUBLE * (k % 200 + 300) AS w, (CASE n % 4 WHEN 2 THEN 0.004 ELSE 463.83 END)::DOUBLE * 400 AS h FROM k),
    edges AS (SELECT province_code, year, epsg, l + w * u AS x, t - h * v AS y FROM images CROSS JOIN (SELECT i / 21.0::DOUBLE AS u, j AS v FROM range(22) a(i) CROSS JOIN range(2) b(j) UNION ALL SELECT j, i / 21.0::DOUBLE FROM range(22) a(i) CROSS JOIN range(2) b(j))),
    ab AS (SELECT *, (y - CASE WHEN epsg > 32700 THEN 10000000 ELSE 0 END) / {_SCALE} AS a, (x - 500000) / {_SCALE} AS b FROM edges),
    uv AS (SELECT *, a - ({_series('u', geo.BETA, 'a', 'b', 'sin', 'cosh')}) AS u, b - ({_series('v', geo.BETA, 'a', 'b', 'cos', 'sinh')}) AS v FROM ab WHERE epsg > 30000),
    sphere AS (SELECT *, asin(sin(u) / cosh(v)) AS s FROM uv),
    points AS (SELECT province_code, year, epsg % 100 * 6 - 183 + degrees(atan2(sinh(v), cos(u))) AS lon, degrees(s + {_series('s', geo.DELTA, 's', None, 'sin', '')}) AS lat FROM sphere
        UNION ALL SELECT province_code, year, x, y FROM edges WHERE epsg = 4326 UNION ALL SELECT province_code, year, NULL, NULL FROM images WHERE epsg IS NULL)
    SELECT province_code, CAST(year AS INT) AS year, round(min(lon), 6) AS west, round(min(lat), 6) AS south, round(max(lon), 6) AS east, round(max(lat), 6) AS north FROM points GROUP BY ALL""")
def projected_extent(spark, d):
    """Bounds in degrees of images on projected grids."""
    return raster.projected_extent(footprints(spark, d), ["province_code", "year"])
