"""Classes, their closing areas, changes of class, and centroids, on small images with known answers."""

import random
from math import asin, atan2, cos, degrees, pi, radians, sin, sqrt

import pytest
from pyspark.sql import functions as F

from lumenfield.operators import centroid, classes

PIXEL = "province_code string, year int, month int, source string, row int, col int, radiation double, mask boolean, pixel_area_km2 double"
KEYS = ["province_code", "year", "source"]


def image(spark, rows, code="01", year=2014, source="VIIRS", area=0.25):
    return spark.createDataFrame([(code, year, 0, source, r, c, v, ok, area) for r, line in enumerate(rows) for c, (v, ok) in enumerate((x if isinstance(x, tuple) else (x, True)) for x in line)], PIXEL)


NAN, INF, NODATA = float("nan"), float("inf"), -9999.0


def test_every_bound_belongs_to_the_upper_class(spark):
    values = [-1.0, 0.0, 0.4999, 0.5, 1.4999, 1.5, 2.9, 3.0, 4.9, 5.0, 1e9, NODATA, NAN, INF, None]
    rows = classes.classified(image(spark, [values + [(9.0, False)]])).orderBy("col").collect()
    assert [r["light_class"] for r in rows] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, None, None, None, None, None]
    assert rows[3]["class_name"] == "weak" and rows[11]["class_name"] is None and rows[0]["scheme"] == "1"
    dmsp = classes.classified(image(spark, [[0.0, 2.5, 5.0, 15.0, 40.0, 63.0]], source="DMSP")).orderBy("col").collect()
    assert [r["light_class"] for r in dmsp] == [1, 2, 3, 4, 5, 5]
    assert classes.classified(image(spark, [[3.0]], source="OTHER")).first()["light_class"] is None
    with pytest.raises(ValueError):
        classes.Scheme("2", ("a", "b", "c"), {"VIIRS": (1.0, 1.0)})


def test_areas_close_on_what_is_seen(spark):
    pixel = image(spark, [[0.1, 0.6, 2.0], [NODATA, 7.0, (7.0, False)]]).unionByName(image(spark, [[NODATA, NAN]], year=2015)).unionByName(image(spark, [[100.0]], code="02", source="DMSP"))
    areas = classes.class_areas(pixel, KEYS)
    got = {(r["province_code"], r["year"], r["light_class"]): (r["pixels"], r["area_km2"]) for r in areas.collect()}
    assert len(got) == 15
    assert [got["01", 2014, k] for k in range(1, 6)] == [(1, 0.25), (1, 0.25), (1, 0.25), (0, 0.0), (1, 0.25)]
    assert [got["01", 2015, k] for k in range(1, 6)] == [(0, 0.0)] * 5  # nothing seen is not dark
    bounds = {r["light_class"]: (r["lower"], r["upper"]) for r in areas.filter("province_code = '02'").collect()}
    assert bounds == {1: (None, 2.5), 2: (2.5, 5.0), 3: (5.0, 15.0), 4: (15.0, 40.0), 5: (40.0, None)}
    natural = spark.createDataFrame([("01", 2.0), ("02", 0.0)], "province_code string, area_km2 double")
    closing = {(r["province_code"], r["year"]): r for r in classes.closing_areas(pixel, areas, natural, KEYS).collect()}
    a, b, c = closing["01", 2014], closing["01", 2015], closing["02", 2014]
    assert (a["class_km2"], a["valid_km2"], a["closes"], a["covered_pct"], a["unseen_km2"]) == (1.0, 1.0, True, 50.0, 1.0)
    assert (b["class_km2"], b["valid_km2"], b["closes"], b["covered_pct"], b["unseen_km2"]) == (0.0, 0.0, True, 0.0, 2.0)
    assert (c["covered_pct"], c["unseen_km2"]) == (None, -0.25)
    # a table of areas that put what wasn't seen into the dark class is found out
    wrong = areas.withColumn("area_km2", F.when(F.col("light_class") == 1, F.col("area_km2") + 0.5).otherwise(F.col("area_km2")))
    assert not any(r["closes"] for r in classes.closing_areas(pixel, wrong, natural, KEYS).collect())
    assert [r["difference_km2"] for r in classes.closing_areas(pixel, wrong, natural, KEYS).collect()] == [0.5] * 3


def test_changes_only_where_both_years_see(spark):
    before = image(spark, [[0.1, 2.0, NODATA, 6.0], [1.0, NAN, 9.0, 0.2]], year=2014)
    after = image(spark, [[0.4, 6.0, 3.0, (6.0, False)], [0.1, None, 4.0, 0.2]], year=2016)
    other = image(spark, [[50.0] * 4], year=2014, source="DMSP")
    third = image(spark, [[50.0] * 4], year=2015)
    changes = classes.change_map(before.unionByName(after).unionByName(other).unionByName(third), "VIIRS", 2014, 2016)
    got = {(r["row"], r["col"]): (r["class_before"], r["class_after"], r["seen"], r["change"]) for r in changes.collect()}
    assert got == {
        (0, 0): (1, 1, "both", "same"), (0, 1): (3, 5, "both", "up"), (0, 2): (None, 4, "after", None), (0, 3): (5, None, "before", None),
        (1, 0): (2, 1, "both", "down"), (1, 1): (None, None, "neither", None), (1, 2): (5, 4, "both", "down"), (1, 3): (1, 1, "both", "same"),
    }
    matrix = classes.transitions(changes).collect()
    assert len(matrix) == 25 and sum(r["area_km2"] for r in matrix) == 1.25 and sum(r["share_pct"] for r in matrix) == pytest.approx(100)
    assert {(r["class_before"], r["class_after"]): r["cells"] for r in matrix if r["cells"]} == {(1, 1): 2, (3, 5): 1, (2, 1): 1, (5, 4): 1}
    s = classes.change_summary(changes).first()
    assert [s[c] for c in ("common_km2", "up_km2", "down_km2", "same_km2", "only_before_km2", "only_after_km2", "unseen_km2", "not_common_pct")] == [1.25, 0.25, 0.5, 0.5, 0.25, 0.25, 0.25, 37.5]
    nothing = classes.change_map(before.filter("false"), "VIIRS", 2014, 2016)
    assert nothing.count() == 0 and sum(r["cells"] or 0 for r in classes.transitions(nothing).collect()) == 0
    for args in (("NONE", 2014, 2016), ("VIIRS", 2014, 2014)):
        with pytest.raises(ValueError):
            classes.change_map(before, *args)


def test_matrix_closes_on_random_images(spark):
    rng = random.Random(2)
    make = lambda y: image(spark, [[(rng.choice([NODATA, 0.2, 1.0, 2.0, 4.0, 8.0]), rng.random() < 0.8) for _ in range(30)] for _ in range(30)], year=y, area=0.21)
    changes = classes.change_map(make(2014).unionByName(make(2015)), "VIIRS", 2014, 2015, ["province_code"])
    total = {r["province_code"]: r["a"] for r in classes.transitions(changes, ["province_code"]).groupBy("province_code").agg(F.sum("area_km2").alias("a")).collect()}
    common = {r["province_code"]: r["common_km2"] for r in classes.change_summary(changes, ["province_code"]).collect()}
    assert total == pytest.approx(common) and total["01"] > 0


def centre(spark, points, **more):
    """``points``: lon, lat, light."""
    df = spark.createDataFrame([("01", float(x), float(y), v, True) for x, y, v in points], "province_code string, lon double, lat double, radiation double, mask boolean")
    return centroid.centroids(centroid.light_moments(df, ["province_code"], **more)).first()


def test_centroids(spark):
    r = centre(spark, [(105, 20, 2.0), (105, 20, 1.0)])
    assert (r["lon"], r["lat"], r["concentration"]) == pytest.approx((105, 20, 1))
    r = centre(spark, [(179, 10, 1.0), (-179, 10, 1.0)])  # over the date line
    assert abs(r["lon"]) == pytest.approx(180) and r["lon"] > 0 and r["lat"] == pytest.approx(10.0014994)
    r = centre(spark, [(170, 0, 3.0), (-170, 0, 1.0)])
    assert r["lon"] == pytest.approx(degrees(atan2(3 * sin(radians(170)) + sin(radians(-170)), 4 * cos(radians(170)))))
    for points in ([(105, 20, 0.0)], [(105, 20, NODATA), (106, 21, None), (107, 22, NAN)]):  # no light
        r = centre(spark, points)
        assert (r["weight"], r["lon"], r["lat"], r["concentration"]) == (0, None, None, None)
    r = centre(spark, [(0, 0, 1.0), (180, 0, 1.0)])  # cancels out
    assert (r["lon"], r["lat"]) == (None, None) and r["concentration"] < 1e-9
    assert centre(spark, [(105, 20, 1.0), (107, 20, 9.0)], background=5.0)["lon"] == pytest.approx(107)
    assert centre(spark, [(0, 90, 1.0)])["lat"] == pytest.approx(90)


def test_parts_can_be_put_together(spark):
    rng = random.Random(5)
    rows = [(f"{k % 3}", k % 5, rng.uniform(100, 110), rng.uniform(8, 24), rng.random() * 9, rng.random() < 0.9, 0.2) for k in range(600)]
    df = spark.createDataFrame(rows, "province_code string, month int, lon double, lat double, radiation double, mask boolean, pixel_area_km2 double")
    whole = {r["province_code"]: r for r in centroid.light_moments(df, ["province_code"]).collect()}
    for r in centroid.merged(centroid.light_moments(df, ["province_code", "month"]), ["province_code"]).collect():
        assert [r[c] for c in centroid.MOMENTS] == pytest.approx([whole[r["province_code"]][c] for c in centroid.MOMENTS])


def test_shifts(spark):
    before = [("01", 179.5, 0.0), ("02", 105.0, 20.0), ("03", 105.0, 20.0), ("04", None, None), ("05", 0.0, 0.0)]
    after = [("01", -179.5, 0.0), ("02", 105.0, 21.0), ("03", 105.0, 20.0), ("04", 105.0, 20.0), ("06", 0.0, 0.0)]
    make = lambda rows: spark.createDataFrame([(c, "VIIRS", x, y) for c, x, y in rows], "province_code string, source string, lon double, lat double")
    got = {r["province_code"]: (r["distance_km"], r["bearing_deg"]) for r in centroid.shifts(make(before), make(after)).collect()}
    degree = pi * centroid.RADIUS_KM / 180
    assert got["01"] == pytest.approx((degree, 90))
    assert got["02"] == pytest.approx((degree, 0))
    assert got["03"] == (0, None)
    assert got["04"] == got["05"] == got["06"] == (None, None)
    # a far way against the law of cosines
    far = spark.createDataFrame([(105.85, 21.03, 2.35, 48.86)], "a double, b double, c double, d double").select(centroid.great_circle_km(*map(F.col, "abcd")).alias("km"), centroid.bearing_deg(*map(F.col, "abcd")).alias("deg")).first()
    p, q, l = radians(21.03), radians(48.86), radians(2.35 - 105.85)  # noqa: E741
    assert far["km"] == pytest.approx(centroid.RADIUS_KM * 2 * asin(sqrt((1 - sin(p) * sin(q) - cos(p) * cos(q) * cos(l)) / 2)))
    assert 300 < far["deg"] < 330
