import pytest
from pyspark.sql import functions as F

from lumenfield.operators import catalogue, export, panel, quality, shaping, timefn
from lumenfield.operators.tables import DAY_FIELDS, ECONOMY_FIELDS, LIGHT_FIELDS, province_series
from lumenfield.plans import registry
from lumenfield.schemas import DAY_ANNUAL, ECONOMY, INDICATORS, LABELS, NTL_ANNUAL, NTL_MONTHLY


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@pytest.fixture(scope="module")
def provinces(spark):
    return spark.createDataFrame([("02", 2, "Đà Nẵng"), ("01", 1, "Bà Rịa"), ("03", 3, "Cà Mau")], "province_code string, number int, province_name string")


def light(spark, *rows):
    return frame(spark, NTL_ANNUAL, *({"source": "VIIRS", "status": "OK", "obs_status": "A"} | r for r in rows))


def test_periods():
    assert [panel.period_label(p) for p in panel.parse_periods(["2024-02", "2023", "2024-01", "2023"])] == ["2023", "2024-01", "2024-02"]
    assert all(panel.parse_periods([x]) is None for x in ("2024-13", "24-01", "abc", ""))
    assert panel.parse_periods(None, 2010, 2012) == [(2010, 0), (2011, 0), (2012, 0)]
    assert panel.check_indicators(["sol", "nope"]) is None and panel.check_indicators([" "]) is None


def test_panel(spark, provinces):
    annual = light(spark, {"province_code": "01", "year": 2009, "sol": 1.0, "source": "DMSP"}, {"province_code": "01", "year": 2010, "sol": 2.0, "obs_status": "B", "source": "DMSP"},
                   {"province_code": "01", "year": 2011, "sol": 3.0, "obs_status": "U"}, {"province_code": "02", "year": 2011})
    months = frame(spark, NTL_MONTHLY, {"province_code": "01", "year": 2011, "month": 3, "sol": 9.0, "sol_ma3": 8.0, "source": "VIIRS"})
    tables = {"ntl_annual": annual, "ntl_monthly": months}
    rows = panel.panel_long(tables, provinces, ["sol", "sol_ma3"], ["2009", "2010", "2011", "2011-03"], ["1", "02"]).collect()
    assert len(rows) == 2 * 2 * 4 and [r.province_code for r in rows[:8]] == ["01"] * 8
    assert [(r.value, r.flag) for r in rows[:4]] == [(1, None), (2, "B"), (3, "U"), (9, None)]
    assert [r.value for r in rows[4:8]] == [None, None, None, 8]
    assert {r.province_code: r.source for r in rows} == {"01": "DMSP/VIIRS", "02": "VIIRS"}
    long = panel.panel_long(tables, provinces, ["sol"], ["2009", "2010", "2011"])
    wide = panel.panel_wide(long, ["2009", "2010", "2011"]).collect()
    assert [tuple(r[-3:]) for r in wide] == [(1, 2, 3), (None,) * 3, (None,) * 3]
    flags = panel.panel_flags_wide(long, ["2009", "2010", "2011"]).first()
    assert flags["2009"] is None and flags["2010"] == "B"
    assert panel.panel_cells(long).count() == 3 and panel.panel_meta(long).first().provinces_with_data == 1
    assert panel.panel_long(tables, provinces, ["sol"], ["2024-13"]) is None


def test_time_functions(spark):
    def run(years, indicator="sol", names=timefn.FUNCTIONS, start=100.0):
        rows = [("01", indicator, str(y), start * 1.1**i) for i, y in enumerate(years)]
        return timefn.time_functions(spark.createDataFrame(rows, "province_code string, indicator string, period string, value double"), names).first()

    r = run(range(2014, 2018))
    assert r.cagr == pytest.approx(10) and r.thay_doi == pytest.approx(33.1) and r.tong == pytest.approx(464.1)
    refused = run(range(2012, 2016))
    assert refused.cagr is None and refused.thay_doi is None and refused.tong is not None and len(refused.refused) == 1
    assert run(range(2012, 2016), "sol_cal").cagr == pytest.approx(10)
    assert len(run(range(2009, 2012), "sol_cal").refused) == 1
    assert run([2014]).cagr is None and run(range(2014, 2016), start=-1.0).thay_doi is None
    assert not hasattr(run([2014], names=["tong", "other"]), "other")


def test_warnings(spark):
    assert quality.panel_warnings(["sol", "sol_cal"], [2009, 2010]) == [quality.BREAK_2010]
    assert quality.panel_warnings(["sol_cal", "NDVI_mean", "gdp"], [2013, 2015]) == [quality.BREAK_2014, quality.TOA, quality.PROVIDED]
    rows = [{"province_code": "01", "year": 2009, "source": "DMSP", "calibration": "PENDING"}, {"province_code": "01", "year": 2010, "source": "DMSP"},
            {"province_code": "02", "year": 2012, "source": "DMSP", "sol_cal": 1.0, "calibration": "X"}, {"province_code": "02", "year": 2014, "sol_cal": 1.0, "status": "GIA_LAP"}]
    day = frame(spark, DAY_ANNUAL, {"province_code": "01", "year": 2016})
    got = {r.province_code: r for r in quality.series_warnings(light(spark, *rows), day, frame(spark, ECONOMY)).collect()}
    assert got["01"].warnings == [quality.TOA, quality.BREAK_2010, quality.NOT_CALIBRATED] and not got["01"].simulated
    assert got["02"].warnings == [quality.SIMULATED_WARNING, quality.USE_CALIBRATED] and got["02"].simulated
    money = frame(spark, ECONOMY, {"province_code": "01", "grdp_price_basis": "so_sanh", "source": "gia_lap b=1"}, {"province_code": "02", "grdp_price_basis": " "})
    assert quality.price_basis_state(money).first().constant_prices is True
    assert quality.price_basis_state(money.withColumn("grdp_price_basis", F.lit("hien_hanh"))).first().constant_prices is False
    assert quality.price_basis_state(money.filter("false")).first().constant_prices is None
    assert len(quality.economy_warnings(money.withColumn("grdp_price_basis", F.lit("hien_hanh"))).first().warnings) == 2
    assert quality.simulated_labels(money).first()[0] == ["gia_lap b=1"]


def test_map_and_coverage(spark, provinces):
    annual = light(spark, *({"province_code": c, "year": 2022, "sol": v} for c, v in (("01", 10.0), ("02", 90.0), ("03", 50.0))))
    rows = catalogue.choropleth({"ntl_annual": annual}, "sol", 2022).collect()
    assert {(r.least, r.greatest, r.upper_median) for r in rows} == {(10, 90, 50)}
    assert catalogue.choropleth({"ntl_annual": annual}, "sol", 2021).collect() == []
    months = frame(spark, NTL_MONTHLY, {"province_code": "01", "year": 2022, "month": 1, "sol_ma3": 1.0}, {"province_code": "01", "year": 2022, "month": 2, "sol_ma3": 2.0})
    assert catalogue.choropleth({"ntl_monthly": months}, "sol_ma3", 2022).first().value == 2
    assert catalogue.national_summary(annual, 2022).first().sol == 150 and catalogue.national_summary(annual, 1999).collect() == []
    cover = {r.indicator: r for r in catalogue.indicator_coverage({"ntl_annual": annual}).collect()}
    assert len(cover) == 28 and (cover["sol"].provinces, cover["gdp"].provinces, cover["gdp"].first_year) == (3, 0, None)
    counts = catalogue.provinces_with_counts(provinces, annual, annual.limit(0)).collect()
    assert [(r.province_code, r.light_rows, r.day_rows) for r in counts] == [("01", 1, 0), ("02", 1, 0), ("03", 1, 0)]
    missing = {r.province_code: r.missing_day for r in quality.missing_parts(provinces, annual, annual.limit(0), annual).collect()}
    assert set(missing.values()) == {True}
    assert catalogue.province(provinces, "1").first().province_name == "Bà Rịa"


def test_shaping(spark, provinces):
    found = lambda x: [r.province_name for r in shaping.search_province(provinces, x).collect()]
    assert found("da nang") == ["Đà Nẵng"] and found("ba ria") == ["Bà Rịa"] and found("zz") == []
    assert [r.province_name for r in shaping.order_vietnamese(provinces).collect()] == ["Bà Rịa", "Cà Mau", "Đà Nẵng"]
    long = provinces.crossJoin(spark.range(2))
    few = shaping.limit_series(long, 2).collect()
    assert {r.province_code for r in few} == {"01", "03"} and {(r.kept, r.total) for r in few} == {(2, 3)}
    assert {r.province_code for r in shaping.limit_series(long, 2, "02").collect()} == {"02"}
    assert shaping.limit_series(long).count() == 6
    assert [r.year for r in shaping.recent_years(spark.range(2020, 2026).select(F.col("id").alias("year")), 2).collect()] == [2024, 2025]


def test_series_and_exports(spark, provinces, tmp_path):
    annual = light(spark, {"province_code": "01", "year": 2010, "sol": 1.0}, {"province_code": "01", "year": 2009, "sol": 0.5})
    day, money = frame(spark, DAY_ANNUAL), frame(spark, ECONOMY)
    parts = province_series(provinces, annual, day, money, "1", 2009, 2010)
    assert [len(parts[k].columns) for k in ("light", "day", "economy")] == [len(LIGHT_FIELDS), len(DAY_FIELDS), len(ECONOMY_FIELDS)] == [26, 16, 5]
    assert [r.year for r in parts["light"].collect()] == [2009, 2010] and parts["day"].collect() == []
    assert province_series(provinces, annual, day, money, "99") is None
    images = spark.createDataFrame([("NTL", 2010, 0, "a.tif"), ("NTL", 2030, 0, "b.tif")], "kind string, year int, month int, path string")
    notes = export.export_bundle(provinces, annual, day, money, images, "01", str(tmp_path / "bundle"), 2009, 2025)
    assert notes == [quality.BREAK_2010, "no day rows in 2009-2025", "no economy rows in 2009-2025"]
    lines = lambda name: [r.value for r in spark.read.text(str(tmp_path / "bundle" / name)).collect()]
    assert lines("day") == [",".join(DAY_FIELDS), "# no day rows in 2009-2025"]
    assert lines("light")[0].startswith("year,source,sol,") and [x[:4] for x in lines("light")[1:]] == ["2009", "2010"]
    assert lines("images") == ["kind,year,path", "NTL,2010,a.tif"]
    for name in ("day", "light", "images", "notes"):  # Spark leaves the byte-order mark out
        assert next((tmp_path / "bundle" / name).glob("part-*")).read_bytes().startswith(b"\xef\xbb\xbf")
    said = lines("notes")
    assert said[:3] == ["topic,detail", 'province,"01 Bà Rịa"', 'years,"2009-2025"'] and sum(x.startswith("sensor,") for x in said) == 2
    assert f'caution,"{quality.BREAK_2010}"' in said and said[-2:] == ['gap,"no day rows in 2009-2025"', 'gap,"no economy rows in 2009-2025"']
    assert export.export_bundle(provinces, annual, day, money, images, "99", str(tmp_path / "none")) is None
    long = panel.panel_long({"ntl_annual": annual}, provinces, ["sol"], ["2009", "2010"])
    notes = ["# Sum of lights (nW/cm2/sr), code sol", "# radiance of the region's pixels above the background", f"# NOTE: {quality.BREAK_2010}", ""]
    wide = ["province_code,province_name,indicator,unit,source,2009,2010", "01,Bà Rịa,sol,nW/cm2/sr,VIIRS,0.5,1.0", "02,Đà Nẵng,sol,nW/cm2/sr,,,", "03,Cà Mau,sol,nW/cm2/sr,,,"]
    rows = ["province_code,province_name,period,indicator,unit,value,source", "01,Bà Rịa,2009,sol,nW/cm2/sr,0.5,VIIRS", "01,Bà Rịa,2010,sol,nW/cm2/sr,1.0,VIIRS"]
    for shape, want in (("rong", wide), ("dai", rows)):
        export.export_panel_csv(long, str(tmp_path / shape), shape, ["sol"], ["2009", "2010"])
        assert [r.value for r in spark.read.text(str(tmp_path / shape)).collect()] == notes + want


def test_every_indicator_has_a_label():
    assert set(LABELS) == {c for c, *_ in INDICATORS} and all(a and b for a, b in LABELS.values())


def test_registered_province_counts_include_day_rows(spark, sf_dir):
    line, supplier, part = (spark.read.parquet(f"{sf_dir}/{t}.parquet").toPandas() for t in ("lineitem", "supplier", "part"))
    nations, parts = dict(zip(supplier.s_suppkey, supplier.s_nationkey)), set(part.p_partkey)
    days = {(nations[s], d.year) for s, p, d in zip(line.l_suppkey, line.l_partkey, line.l_shipdate) if s in nations and p in parts}
    got = {int(r.province_code): r.day_rows for r in registry.QUERIES["provinces_with_counts"](spark, sf_dir).collect()}
    assert got == {i: sum(n == i for n, _ in days) for i in got} and sum(got.values()) == len(days) > 0


def test_requests_with_unknown_codes_are_refused(spark):
    asked = [" sol , gdp", "sol,gdp,", "sol;gdp", "SOL", "", " , ", None, "NDVI_mean", "sol,nope"]
    rows = panel.checked_requests(spark.createDataFrame(list(enumerate(asked)), "i int, indicators string")).orderBy("i").collect()
    assert [r.accepted for r in rows] == [panel.check_indicators(x.split(",")) if x is not None else None for x in asked]
    assert [r.accepted for r in rows] == [["sol", "gdp"], ["sol", "gdp"], None, None, None, None, None, ["NDVI_mean"], None]


def test_flags_are_explained(spark):
    rows = quality.explained(spark.createDataFrame([("A",), ("B",), ("L",), ("O",), ("U",), (None,), ("x",)], "obs_status string")).collect()
    assert [r.flag_text for r in rows] == [None, quality.FLAGS["B"], quality.FLAGS["L"], quality.FLAGS["O"], quality.FLAGS["U"], None, None]
