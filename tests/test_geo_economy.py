"""Projected extents, and the economy in two price bases."""

from math import cos, radians, sin, sqrt, tan

import pytest
from pyspark.sql import functions as F

from lumenfield.functions import geo
from lumenfield.operators import economy, raster
from lumenfield.sources import ingest


def meridian_arc(lat, steps=20000):
    """By Simpson's rule over the radius of curvature."""
    f = lambda t: geo.MAJOR * (1 - geo.E2) / (1 - geo.E2 * sin(t) ** 2) ** 1.5
    h = radians(lat) / steps
    return h / 3 * (f(0) + f(radians(lat)) + sum((4 if i % 2 else 2) * f(i * h) for i in range(1, steps)))


def forward(lon, lat, meridian):
    """The classical power series about the central meridian, whose terms go to the sixth power of the difference in longitude."""
    p, e2 = radians(lat), geo.E2
    ep = e2 / (1 - e2)
    n, t, c, a = geo.MAJOR / sqrt(1 - e2 * sin(p) ** 2), tan(p) ** 2, ep * cos(p) ** 2, radians(lon - meridian) * cos(p)
    x = geo.UTM_SCALE * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * a**5 / 120) + geo.UTM_EAST
    y = geo.UTM_SCALE * (meridian_arc(lat) + n * tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * a**6 / 720))
    return x, y


def test_inverse_of_known_points(spark):
    rows, want = [], []
    for zone, lon, lat in ((48, 105.0, 21.0), (48, 107.4, 8.5), (49, 109.2, 23.4), (48, 102.5, 16.0), (31, 0.0, 48.86), (1, -179.9, 10.0)):
        x, y = forward(lon, lat, zone * 6 - 183)
        rows.append((x, y, 32600 + zone))
        want.append((lon, lat))
    x, y = forward(106.0, 30.0, 105)
    rows.append((x, 1e7 - y, 32748))
    want.append((106.0, -30.0))
    rows += [(500000.0, 0.0, 32648), (105.5, 21.5, 4326)]
    want += [(105.0, 0.0), (105.5, 21.5)]
    df = spark.createDataFrame(rows, "x double, y double, epsg int")
    got = [(r["p"]["lon"], r["p"]["lat"]) for r in df.select(geo.to_degrees(F.col("x"), F.col("y"), F.col("epsg")).alias("p")).collect()]
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=1e-7)


IMAGE = "name string, crs_epsg int, left double, top double, pixel_width double, pixel_height double, cols int, rows int"


def test_bent_edges_widen_the_extent(spark):
    rows = [("utm", 32648, 250000.0, 2600000.0, 500.0, -500.0, 1000, 400), ("plain", 4326, 102.0, 23.0, 0.5, -0.5, 10, 20), ("none", None, 1.0, 2.0, 3.0, 4.0, 5, 6), ("gap", 32648, None, 2.0, 3.0, 4.0, 5, 6)]
    got = {r["name"]: (r["west"], r["south"], r["east"], r["north"]) for r in raster.projected_extent(spark.createDataFrame(rows, IMAGE), ["name"]).collect()}
    assert got["plain"] == (102.0, 13.0, 107.0, 23.0)
    assert got["none"] == got["gap"] == (None,) * 4
    west, south, east, north = got["utm"]
    corners = spark.createDataFrame([(x, y) for x in (250000.0, 750000.0) for y in (2400000.0, 2600000.0)], "x double, y double")
    at = [r["p"] for r in corners.select(geo.to_degrees(F.col("x"), F.col("y"), F.lit(32648)).alias("p")).collect()]
    assert north > max(p["lat"] for p in at) + 0.005 and south == pytest.approx(min(p["lat"] for p in at), abs=1e-6)
    assert (west, east) == pytest.approx((min(p["lon"] for p in at), max(p["lon"] for p in at)), abs=1e-6)
    top = spark.range(1).select(geo.to_degrees(F.lit(500000.0), F.lit(2600000.0), F.lit(32648)).alias("p")).first()["p"]["lat"]
    assert north == pytest.approx(top, abs=1e-4)
    with pytest.raises(Exception, match="neither WGS 84"):
        raster.projected_extent(spark.createDataFrame([("x", 3405, 1.0, 2.0, 3.0, 4.0, 5, 6)], IMAGE), ["name"]).collect()


MONEY = "province_code string, year int, population string, grdp string, grdp_price_basis string, source string"


def money(spark, rows):
    return ingest.load_economy(spark.createDataFrame(rows, MONEY), by_basis=True)


def test_both_bases_stand_side_by_side(spark):
    rows = [("1", 2014, "100", "10", "so_sanh", "x"), ("1", 2014, "90", "12", "hien_hanh", "x"), ("1", 2015, "", "11", "so_sanh", "x"), ("2", 2014, "7", "5", "hien_hanh", "gia_lap 1"), ("3", 2014, "8", "9", "", "x")]
    own = money(spark, rows)
    assert own.count() == 5
    with pytest.raises(ValueError, match="01, 2014, hien_hanh"):
        money(spark, rows + [("01", 2014, "1", "1", "hien_hanh", "y")])
    with pytest.raises(ValueError):
        ingest.load_economy(spark.createDataFrame(rows, MONEY))
    light = spark.createDataFrame([(c, y, 0, 1.0) for c in ("01", "02", "03", "04") for y in (2014, 2015)], "province_code string, year int, month int, sol_cal double")
    got = {(r["province_code"], r["year"]): (r["gdp_constant"], r["gdp_current"], r["simulated_current"], r["population"]) for r in economy.attach_both_bases(light, own).collect()}
    assert len(got) == 8
    assert got["01", 2014] == (10, 12, False, 100) and got["01", 2015] == (11, None, None, None)
    assert got["02", 2014] == (None, 5, True, 7) and got["03", 2014] == (None, None, None, 8) and got["04", 2014] == (None,) * 4
    grown = {(r["province_code"], r["year"]): (r["growth_constant_pct"], r["growth_current_pct"], r["deflator"]) for r in economy.growth_by_basis(economy.attach_both_bases(light, own)).collect()}
    assert grown["01", 2015] == (10.0, None, None) and grown["01", 2014][2] == 120.0


def test_models_are_fitted_on_the_same_rows(spark):
    """Constant prices follow light ** 0.8; current ones light ** 1.1 where both are there, and anything where only they are."""
    light, rows = [], []
    for p in range(6):
        for y in range(2012, 2017):
            x = 2.0 + p + 0.3 * (y - 2010)
            light.append((f"{p:02}", y, 0, x if (p, y) != (0, 2014) else 0.0))
            if (p, y) != (1, 2015):
                rows.append((f"{p:02}", y, "1", repr(3 * x**0.8), "so_sanh", "x"))
            if p != 2:
                rows.append((f"{p:02}", y, "1", repr(2 * x**1.1 if (p, y) != (1, 2015) else 1e9), "hien_hanh", "x" if p != 3 else "GIA_LAP"))
    light.append(("04", 2015, 6, 99.0))  # a month
    joined = economy.attach_both_bases(spark.createDataFrame(light, "province_code string, year int, month int, sol_cal double"), money(spark, rows))
    got = {r["price_basis"]: r for r in economy.models_by_basis(joined, minimum=5).collect()}
    a, b = got["so_sanh"], got["hien_hanh"]
    assert a["n"] == b["n"] == 3 * 4 - 2  # without 2 and 3, (0, 2014) and (1, 2015); 2014 to 2016
    assert (a["own_n"], b["own_n"]) == (16, 11)
    assert (a["beta"], b["beta"], a["r2"]) == pytest.approx((0.8, 1.1, 1.0))
    assert (a["official"], b["official"]) == (True, False)
    assert economy.models_by_basis(joined).count() == 2 and economy.models_by_basis(joined, minimum=11).count() == 0


def test_derived_indicators(spark):
    schema = "province_code string, year int, month int, source string, sol double, sol_cal double, lit_sol double, lit_area_km2 double, gdp double, predicted_gdp double"
    rows = [
        ("01", 2014, 0, "VIIRS", 30.0, 30.0, 20.0, 4.0, 120.0, 100.0), ("02", 2014, 0, "VIIRS", 10.0, 10.0, 0.0, 0.0, 0.0, 50.0), ("03", 2014, 0, "VIIRS", None, None, None, None, None, None),
        ("01", 2015, 0, "VIIRS", 30.0, 30.0, 20.0, 8.0, 90.0, 100.0), ("02", 2015, 0, "VIIRS", 30.0, 30.0, 1.0, 0.5, 5.0, 0.0), ("01", 2017, 0, "VIIRS", 0.0, 0.0, 0.0, 0.0, 1.0, None), ("01", 2013, 0, "DMSP", 7.0, 9.0, 1.0, 1.0, 3.0, 2.0), ("01", 2015, 6, "VIIRS", 99.0, 99.0, 9.0, 9.0, 9.0, 9.0),
    ]
    names = ("gdp_gap_pct", "light_per_gdp", "lit_intensity", "national_share_pct", "share_shift")
    got = {(r["province_code"], r["year"]): tuple(r[c] for c in names) for r in economy.derived_indicators(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        ("01", 2014): (20.0, 0.25, 5.0, 75.0, None), ("02", 2014): (-100.0, None, None, 25.0, None), ("03", 2014): (None,) * 5,
        ("01", 2015): (-10.0, 30 / 90, 2.5, 50.0, -25.0), ("02", 2015): (None, 6.0, 2.0, 50.0, 25.0), ("01", 2017): (None, 0.0, None, None, None), ("01", 2013): (50.0, 3.0, 1.0, 100.0, None),
    }
