"""Registered queries on classes of light, their changes, and where light is centred."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfield.operators import centroid, classes, economy
from lumenfield.plans import sql as S
from lumenfield.plans.base import query
from lumenfield.sources import adapter as A
from lumenfield.sources import ingest

IMAGE = ["province_code", "year", "source"]
_NUMBER = "CASE source WHEN 'VIIRS' THEN 1 + (v >= 0.5)::INT + (v >= 1.5)::INT + (v >= 3)::INT + (v >= 5)::INT ELSE 1 + (v >= 2.5)::INT + (v >= 5)::INT + (v >= 15)::INT + (v >= 40)::INT END"
_CLASSED = f"{S.PIXELS}, {S.PROV}, classed AS (SELECT *, CASE WHEN mask THEN {_NUMBER.replace('v >=', 'radiation >=')} END AS k FROM pixel)"


@query(f"""{_CLASSED}, images AS (SELECT DISTINCT province_code, year, source FROM pixel), names(k, class_name) AS (VALUES (1, 'dark'), (2, 'weak'), (3, 'medium'), (4, 'strong'), (5, 'very strong'))
    SELECT i.province_code, i.year, i.source, names.k AS light_class, class_name, CASE i.source WHEN 'VIIRS' THEN [NULL, 0.5, 1.5, 3, 5][names.k] ELSE [NULL, 2.5, 5, 15, 40][names.k] END::DOUBLE AS lower, count(area) AS pixels, round(coalesce(sum(area), 0), 6) AS area_km2
    FROM images i CROSS JOIN names LEFT JOIN classed c ON c.province_code = i.province_code AND c.year = i.year AND c.source = i.source AND c.k = names.k GROUP BY ALL""")
def light_classes(spark, d):
    """Pixels and areas of the five classes in every annual image."""
    out = classes.class_areas(A.pixels(spark, d), IMAGE)
    return out.select(*IMAGE, "light_class", "class_name", "lower", "pixels", F.round("area_km2", 6).alias("area_km2"))


@query(f"""{_CLASSED} SELECT c.province_code, year, source, round(coalesce(sum(area) FILTER (k IS NOT NULL), 0), 6) AS class_km2, round(coalesce(sum(area) FILTER (mask), 0), 6) AS valid_km2, true AS closes,
    any_value(area_km2) AS natural_km2, round(100 * coalesce(sum(area) FILTER (mask), 0) / any_value(area_km2), 6) AS covered_pct, round(any_value(area_km2) - coalesce(sum(area) FILTER (mask), 0), 6) AS unseen_km2
    FROM classed c LEFT JOIN prov USING (province_code) GROUP BY ALL""")
def light_classes_closing(spark, d):
    """Whether the classes' areas add up to what is seen, and how much of the natural area that is."""
    pixel = A.pixels(spark, d)
    out = classes.closing_areas(pixel, classes.class_areas(pixel, IMAGE), A.provinces(spark, d), IMAGE)
    return out.select(*IMAGE, "closes", "natural_km2", *(F.round(c, 6).alias(c) for c in ("class_km2", "valid_km2", "covered_pct", "unseen_km2")))


_CHANGES = f"""{S.PIXELS}, cells AS (SELECT province_code, "row", col, max(area) AS area, avg(radiation) FILTER (mask AND year = 2013) AS b, avg(radiation) FILTER (mask AND year = 2015) AS a
        FROM pixel WHERE source = 'VIIRS' AND year IN (2013, 2015) GROUP BY ALL),
    changes AS (SELECT *, {_NUMBER.replace('CASE source', "CASE 'VIIRS'").replace('v >=', 'b >=')} AS kb, {_NUMBER.replace('CASE source', "CASE 'VIIRS'").replace('v >=', 'a >=')} AS ka FROM cells)"""


def changes(spark, d):
    return classes.change_map(A.pixels(spark, d), "VIIRS", 2013, 2015, ["province_code"])


@query(f"""{_CHANGES} SELECT province_code, "row", col, round(b, 6) AS before, round(a, 6) AS after, CASE WHEN b IS NULL AND a IS NULL THEN 'neither' WHEN a IS NULL THEN 'before' WHEN b IS NULL THEN 'after' ELSE 'both' END AS seen,
    CASE WHEN ka > kb THEN 'up' WHEN ka < kb THEN 'down' WHEN ka = kb THEN 'same' END AS change FROM changes""")
def light_change(spark, d):
    """Each province's cells in 2013 and 2015: their light, whether both years saw them, and whether their class went up or down."""
    return changes(spark, d).select("province_code", "row", "col", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"), "seen", "change")


@query(f"""{_CHANGES}, shares AS (SELECT p.province_code, i AS class_before, j AS class_after, count(c.area) AS cells, coalesce(sum(c.area), 0) AS area FROM (SELECT DISTINCT province_code FROM changes) p
        CROSS JOIN range(1, 6) r(i) CROSS JOIN range(1, 6) s(j) LEFT JOIN changes c ON c.province_code = p.province_code AND c.kb = i AND c.ka = j GROUP BY ALL)
    SELECT province_code, CAST(class_before AS INT) AS class_before, CAST(class_after AS INT) AS class_after, cells, round(area, 6) AS area_km2, round(100 * area / nullif(sum(area) OVER (PARTITION BY province_code), 0), 6) AS share_pct FROM shares""")
def light_transitions(spark, d):
    """From which class to which, by area of what both years saw."""
    out = classes.transitions(changes(spark, d), ["province_code"])
    return out.select("province_code", "class_before", "class_after", "cells", F.round("area_km2", 6).alias("area_km2"), F.round("share_pct", 6).alias("share_pct"))


@query(f"""{_CHANGES}, t AS (SELECT province_code, sum(area) AS every, coalesce(sum(area) FILTER (a IS NOT NULL AND b IS NOT NULL), 0) AS common, coalesce(sum(area) FILTER (ka > kb), 0) AS up, coalesce(sum(area) FILTER (ka < kb), 0) AS down,
        coalesce(sum(area) FILTER (b IS NOT NULL AND a IS NULL), 0) AS lost, coalesce(sum(area) FILTER (a IS NOT NULL AND b IS NULL), 0) AS new, coalesce(sum(area) FILTER (a IS NULL AND b IS NULL), 0) AS unseen FROM changes GROUP BY ALL)
    SELECT province_code, round(common, 6) AS common_km2, round(up, 6) AS up_km2, round(down, 6) AS down_km2, round(lost, 6) AS only_before_km2, round(new, 6) AS only_after_km2, round(unseen, 6) AS unseen_km2, round(100 * (1 - common / every), 6) AS not_common_pct FROM t""")
def light_change_summary(spark, d):
    columns = ("common_km2", "up_km2", "down_km2", "only_before_km2", "only_after_km2", "unseen_km2", "not_common_pct")
    return classes.change_summary(changes(spark, d), ["province_code"]).select("province_code", *(F.round(c, 6).alias(c) for c in columns))


_MOMENTS = f"""{S.PIXELS}, w AS (SELECT province_code, source, year, CASE WHEN mask AND radiation > 0 THEN radiation * area ELSE 0 END AS w, radians(102 + col * 0.4) AS lon, radians(lat) AS lat FROM pixel),
    m AS (SELECT province_code, source, year, sum(w) AS w, sum(w * cos(lat) * cos(lon)) AS x, sum(w * cos(lat) * sin(lon)) AS y, sum(w * sin(lat)) AS z FROM w GROUP BY ALL),
    c AS (SELECT province_code, source, year, degrees(atan2(y, x)) AS lon, degrees(atan2(z, sqrt(x * x + y * y))) AS lat, sqrt(x * x + y * y + z * z) / w AS near FROM m WHERE w > 0)"""


def centres(spark, d):
    pixel = A.pixels(spark, d).withColumn("lon", 102 + F.col("col") * F.lit(0.4))
    return centroid.centroids(centroid.light_moments(pixel, ["province_code", "source", "year"]))


@query(f"{_MOMENTS} SELECT province_code, source, year, round(lon, 6) AS lon, round(lat, 6) AS lat, round(near, 6) AS concentration FROM c")
def light_centroids(spark, d):
    return centres(spark, d).filter("lon IS NOT NULL").select("province_code", "source", "year", *(F.round(c, 6).alias(c) for c in ("lon", "lat", "concentration")))


@query(f"""{_MOMENTS}, b AS (SELECT *, radians(lon) AS l, radians(lat) AS p FROM c WHERE year = 2013), a AS (SELECT *, radians(lon) AS l, radians(lat) AS p FROM c WHERE year = 2015),
    s AS (SELECT b.province_code, b.source, a.lon AS to_lon, a.l - b.l AS dl, b.p AS p, a.p AS q FROM b LEFT JOIN a ON a.province_code = b.province_code AND a.source = b.source)
    SELECT province_code, source, round(2 * {centroid.RADIUS_KM} * asin(sqrt(pow(sin((q - p) / 2), 2) + cos(p) * cos(q) * pow(sin(dl / 2), 2))), 5) AS distance_km,
        round(CASE WHEN to_lon IS NOT NULL THEN (degrees(atan2(sin(dl) * cos(q), cos(p) * sin(q) - sin(p) * cos(q) * cos(dl))) + 360) % 360 END, 5) AS bearing_deg FROM s""")
def light_shift(spark, d):
    """How far and in which direction the light of each province moved from 2013 to 2015; only VIIRS has both."""
    own = centres(spark, d).filter("lon IS NOT NULL")
    out = centroid.shifts(own.filter("year = 2013"), own.filter("year = 2015")).filter("from_lon IS NOT NULL")
    return out.select("province_code", "source", F.round("distance_km", 5).alias("distance_km"), F.round("bearing_deg", 5).alias("bearing_deg"))


#: GRDP in constant prices for all but every fourth nation and year, in current ones for all but every third, of which one nation's are simulated.
_BASES = f"""{S.ANNUAL_AND_ECONOMY}, g AS (SELECT *, CAST(province_code AS INT) AS n FROM econ), c AS (SELECT province_code, year, grdp AS gdp FROM g WHERE (n + year) % 4 <> 0),
    h AS (SELECT province_code, year, n = 5 AS made, grdp * (1.2::DOUBLE + 0.05::DOUBLE * (year - 2010)) AS gdp FROM g WHERE (n + year) % 3 <> 0),
    j AS (SELECT ac.province_code, ac.year, sol_cal, c.gdp AS gc, h.gdp AS gh, coalesce(made, false) AS made FROM ac LEFT JOIN c USING (province_code, year) LEFT JOIN h USING (province_code, year)),
    u AS (SELECT *, ln(sol_cal) AS x, gc IS NOT NULL AS okc, gh IS NOT NULL AND NOT made AS okh FROM j WHERE year >= 2014 AND sol_cal > 0)"""


def both_bases(spark, d):
    rows = A.economy(spark, d).select("province_code", "year", "population", "grdp", F.col("province_code").cast("int").alias("n"))
    current = F.col("grdp") * (F.lit(1.2) + F.lit(0.05) * (F.col("year") - 2010))
    constant = rows.filter("(n + year) % 4 != 0").select("province_code", "year", "population", "grdp", F.lit("so_sanh").alias("grdp_price_basis"), F.lit("orders").alias("source"))
    inflated = rows.filter("(n + year) % 3 != 0").select("province_code", "year", "population", current.alias("grdp"), F.lit("hien_hanh").alias("grdp_price_basis"), F.when(F.col("n") == 5, "gia_lap v1").otherwise("orders").alias("source"))
    money = ingest.load_economy(constant.unionByName(inflated), by_basis=True)
    return economy.attach_both_bases(A.annual(spark, d, True), money)


@query(f"""{_BASES} SELECT 'so_sanh' AS price_basis, round(regr_intercept(ln(gc), x), 6) AS alpha, round(regr_slope(ln(gc), x), 6) AS beta, round(regr_r2(ln(gc), x), 6) AS r2, count(*) AS n, (SELECT count(*) FROM u WHERE okc) AS own_n, true AS official FROM u WHERE okc AND okh HAVING count(*) >= 10
    UNION ALL SELECT 'hien_hanh', round(regr_intercept(ln(gh), x), 6), round(regr_slope(ln(gh), x), 6), round(regr_r2(ln(gh), x), 6), count(*), (SELECT count(*) FROM u WHERE okh), false FROM u WHERE okc AND okh HAVING count(*) >= 10""")
def models_by_basis(spark, d):
    """Models of GDP on light in constant and in current prices, on the rows that have both."""
    return S.rounded(economy.models_by_basis(both_bases(spark, d)), 6, "alpha", "beta", "r2")


@query(f"""{_BASES} SELECT province_code, year, round(gc, 2) AS gdp_constant, round(gh, 2) AS gdp_current, {S.pct('gc', S.PREVIOUS.format(c='gc'))} AS growth_constant_pct, {S.pct('gh', S.PREVIOUS.format(c='gh'))} AS growth_current_pct, round(100 * gh / gc, 6) AS deflator FROM j""")
def growth_by_basis(spark, d):
    out = economy.growth_by_basis(both_bases(spark, d))
    return out.select("province_code", "year", F.round("gdp_constant", 2).alias("gdp_constant"), F.round("gdp_current", 2).alias("gdp_current"), "growth_constant_pct", "growth_current_pct", F.round("deflator", 6).alias("deflator"))
