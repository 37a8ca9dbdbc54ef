import math

import pytest
from pyspark.sql import functions as F

from lumenfield.functions.columns import decimal_year, pad_code, pixel_area_km2
from lumenfield.operators import economy, models, quality, series, tables, zonal
from lumenfield.schemas import IMAGE_META, PIXEL

NO = -9999.0


def pixels(spark, images):
    """images: (code, year, month, source, values[, cf_cvg[, masked positions]]), pixels of 1 km2."""
    rows = []
    for code, year, month, source, values, *more in images:
        cf = more[0] if more else [None] * len(values)
        off = more[1] if len(more) > 1 else ()
        rows += [(code, year, month, source, 0, i, float(v), c, i not in off, 1.0) for i, (v, c) in enumerate(zip(values, cf))]
    return spark.createDataFrame(rows, PIXEL)


def meta(spark, images, area=10.0, tag=None):
    return spark.createDataFrame([(i[0], f"P{i[0]}", i[1], i[2], i[3], "x.tif", area, tag, 1) for i in images], IMAGE_META)


def stats(spark, images, area=10.0, tag=None):
    out = zonal.with_area(zonal.zonal_stats(pixels(spark, images), meta(spark, images, area, tag)))
    return quality.note(quality.obs_status(out))


def one(df):
    (row,) = df.collect()
    return row


def test_pixel_statistics(spark):
    r = one(stats(spark, [("01", 2020, 0, "VIIRS", [0, 0.25, 0.5, 1.5, 2, NO, float("nan"), float("inf")])]))
    values = [0, 0.25, 0.5, 1.5, 2]
    mean = sum(values) / 5
    assert (r.valid_pixels, r.sol, r.sol_raw, r.background_pixels, r.lit_pixels, r.lit_area_km2) == (5, 4, 4.25, 2, 2, 2)
    assert r.rad_mean == pytest.approx(mean) and r.rad_std == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 5), abs=1e-6)
    assert (r.rad_min, r.rad_max, r.lit_pixel_pct, r.lit_sol, r.lit_area_pct, r.sol_density) == (0, 2, 40, 3.5, 20, 0.4)
    masked = one(stats(spark, [("01", 2020, 0, "VIIRS", [0, 0.25, 0.5, 1.5, 2], [None] * 5, (3,))]))
    assert masked.sol == 2.5


def test_empty_image_keeps_its_row(spark):
    for values in ([NO, float("nan")], []):
        images = [("01", 2020, 0, "VIIRS", values)]
        r = one(stats(spark, images))
        assert (r.valid_pixels, r.sol, r.sol_density, r.obs_status, r.status, r.lit_area_km2) == (0, None, None, "L", "INSUFFICIENT_QUALITY", None)
        assert r.background_threshold == 0.5 and r.background_pixels is None


def test_dark_and_negative_pixels(spark):
    dark = one(stats(spark, [("01", 2020, 0, "VIIRS", [0.0, -0.25])]))
    assert (dark.sol, dark.rad_cv, dark.spatial_cv) == (0, None, 0)
    dmsp = one(stats(spark, [("01", 2010, 0, "DMSP", [-1.0, 6.0])]))
    assert (dmsp.sol, dmsp.background_pixels, dmsp.lit_pixels, dmsp.obs_status) == (5, 0, 1, "B")


def test_cloud_tag_and_band(spark):
    r = one(stats(spark, [("01", 2020, 1, "VIIRS", [0.0])], tag=1.5))
    assert (r.sol, r.sol_density, r.status, r.obs_status, r.cloud_free_obs, r.period) == (0, 0, "OK", "U", 1.5, "2020-01")
    assert one(stats(spark, [("01", 2020, 1, "VIIRS", [1.0, 2.0, NO], [2.0, 4.0, 100.0])], tag=9.0)).cloud_free_obs == 3


def test_pixel_area(spark):
    row = spark.range(1).select(
        pixel_area_km2(F.lit(0.5), F.lit(-0.5), F.lit(4326), F.lit(60.0)).alias("a"), pixel_area_km2(F.lit(500.0), F.lit(-500.0), F.lit(32648), F.lit(60.0)).alias("b")
    ).first()
    assert row.a == pytest.approx(0.25 * 111.32**2 * 0.5) and row.b == 0.25
    with pytest.raises(Exception, match="CRS"):
        spark.range(1).select(pixel_area_km2(F.lit(0.5), F.lit(0.5), F.lit(None).cast("int"), F.lit(60.0)).alias("a")).collect()


def test_calendar_gaps(spark):
    months = [(2023, 10), (2023, 12), (2024, 1), (2024, 3)]
    rows = series.monthly_changes(stats(spark, [("01", y, m, "VIIRS", [2.0]) for y, m in months])).orderBy("year", "month").collect()
    assert [r.sol_change_mom_pct for r in rows] == [None, None, 0, None]
    rows = series.monthly_changes(stats(spark, [("01", y, m, "VIIRS", [200.0 if m == 10 else 2.0]) for y, m in months])).orderBy("year", "month").collect()
    assert rows[2].sol_ma3 == 2
    yoy = series.monthly_changes(stats(spark, [("01", 2013, 5, "VIIRS", [2.0]), ("01", 2014, 5, "VIIRS", [3.0])])).filter("year = 2014")
    assert one(yoy).sol_change_yoy_pct == 50


def test_row_against_calendar(spark):
    rows = series.row_changes(series.monthly_changes(stats(spark, [("01", 2020, 1, "VIIRS", [0.25, 2.0]), ("01", 2020, 3, "VIIRS", [0.25, 4.0])]))).orderBy("month").collect()
    assert (rows[0].sol_raw, rows[0].sol, rows[1].tnl_ma3, rows[1].tnl_mom_growth_pct, rows[1].sol_change_mom_pct) == (2.25, 2, 3.25, 88.8889, None)


def test_sensor_change(spark):
    every = stats(spark, [("01", 2013, 0, "DMSP", [10.0]), ("01", 2013, 0, "VIIRS", [10.0]), ("01", 2014, 0, "VIIRS", [10.0]), ("01", 2015, 0, "VIIRS", [11.0])])
    rows = {r.year: r for r in models.apply_calibration(series.annual_change(zonal.annual_rows(every))).collect()}
    assert sorted(rows) == [2013, 2014, 2015] and rows[2013].source == "DMSP"
    assert rows[2014].sol_change_pct is None and rows[2014].obs_status == "B" and rows[2014].note and rows[2015].sol_change_pct == 10
    assert rows[2013].calibration == "PENDING" and rows[2013].sol_cal is None and rows[2014].sol_cal == 10
    assert one(models.overlap_pairs(every)).sol_viirs == 10


def test_calibration(spark):
    images = []
    for i in range(30):
        x = float(i + 2)
        y = 2 * x**1.5
        images += [(f"{i:02}", 2013, 0, "DMSP", [x]), (f"{i:02}", 2013, 0, "VIIRS", [y]), (f"{i:02}", 2014, 0, "VIIRS", [y * 1.1])]
    every = stats(spark, images)
    model = models.fit_calibration(models.overlap_pairs(every))
    rows = series.calibrated_change(models.calibrated_density(models.apply_calibration(zonal.annual_rows(every), model))).filter("province_code = '00'").orderBy("year").collect()
    assert rows[0].sol == 2 and rows[0].sol_cal == pytest.approx(2 * 2**1.5, abs=1e-3) and rows[1].sol_change_cal_pct == pytest.approx(10, abs=0.02)
    assert rows[0].sol_density_cal == pytest.approx(rows[0].sol_cal / 10, abs=1e-6)
    with pytest.raises(ValueError):
        models.fit_calibration(models.overlap_pairs(every.filter("province_code != '00'")))


def money(spark, basis="so_sanh", source="real"):
    rows = [("01", y, 100.0, 3.0 * (y - 2012) ** 2, basis, source) for y in range(2014, 2025)]
    return spark.createDataFrame(rows, "province_code string, year int, population double, gdp double, price_basis string, economy_source string")


def test_gdp_model(spark):
    every = stats(spark, [("01", y, 0, "VIIRS", [float(y - 2012)]) for y in range(2014, 2025)])
    light = models.apply_calibration(series.annual_change(zonal.annual_rows(every)))

    def run(m):
        j = economy.attach_economy(light, m)
        model = models.gdp_model(j)
        return model, models.predicted_gdp(models.light_gdp_elasticity(economy.sol_per_capita(j)), model).orderBy("year").collect()

    model, rows = run(money(spark))
    m = one(model)
    assert m.beta == pytest.approx(2) and m.r2 == pytest.approx(1) and m.n == 11
    assert rows[0].sol_per_capita == 0.02 and rows[0].light_gdp_elasticity is None and rows[1].light_gdp_elasticity == pytest.approx(0.4)
    assert all(r.predicted_gdp == pytest.approx(r.gdp, rel=1e-6) for r in rows)
    for other in (money(spark, basis="hien_hanh"), money(spark, source="x gia_lap y")):
        model, rows = run(other)
        assert model.collect() == [] and all(r.predicted_gdp is None for r in rows)
    assert [r.model for r in models.calculation_models(None, run(money(spark))[0]).collect()] == ["gdp_log_regression"]


def test_elasticity(spark):
    rows = [(f"{p:02}", 2010 + y, float(5 + p + y * (p + 1)), None) for p in range(6) for y in range(12)]
    df = spark.createDataFrame([(c, y, s, math.exp(2) * s**0.8) for c, y, s, _ in rows], "province_code string, year int, sol double, grdp double")
    pooled = one(models.elasticity_pooled(df))
    assert (pooled.beta, pooled.n, pooled.warnings) == (0.8, 72, [])
    assert models.elasticity_by_province(df).count() == 6
    few = df.filter("year < 2014")
    assert models.elasticity_by_province(few).count() == 0
    assert one(models.elasticity_pooled(df.limit(4))).beta is None
    flat = one(models.fit_log_model(df.withColumn("grdp", F.lit(3.0)), "sol", "grdp", 2))
    assert flat.r2 is None and models.fit_log_model(df.withColumn("sol", F.lit(3.0)), "sol", "grdp", 2).collect() == []


def test_night_tables(spark):
    every = models.apply_calibration(series.row_changes(stats(spark, [("01", 2020, 1, "VIIRS", [1.0, 2.0])])))
    provinces = spark.createDataFrame([("01", "VNM.1_1")], "province_code string, gid_1 string")
    r = one(tables.night_data(every, provinces))
    assert len(r) == 20 and (r.gid_1, r.tnl, r.total_pixels, r.avg_rad, r.cf_cvg) == ("VNM.1_1", 3, 2, "x.tif#band=1", None)
    with pytest.raises(Exception, match="no such province"):
        tables.night_data(every, provinces.filter("false")).collect()


def test_scalars(spark):
    rows = spark.createDataFrame([("1",), ("123",), (" 7 ",), ("2010",), ("2024-07",), ("2024-13",), (None,)], "x string").select(pad_code("x").alias("p"), decimal_year("x").alias("t")).collect()
    assert [r.p for r in rows][:3] == ["01", "123", "07"]
    assert [r.t for r in rows] == [None, None, None, 2010.0, pytest.approx(2024 + 6.5 / 12), None, None]
