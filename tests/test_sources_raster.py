import json

import pytest
from pyspark.sql import functions as F

from lumenfield.operators import raster
from lumenfield.schemas import NTL_ANNUAL, NTL_MONTHLY
from lumenfield.sources import catalogue, ingest


def csv(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8-sig")
    return str(path)


def test_csv_to_annual(spark, tmp_path):
    raw = ingest.load_indicator_csv(spark, csv(tmp_path, "a.csv", "province_code,nam,source,sol,rad_cv,extra\n1,2010,DMSP,1.5,NA,x\n1,2010,VIIRS,2.5,0.5,x\n02,2011,,-9999,abc,x\n,2011,VIIRS,1,1,x\n3,20x,VIIRS,1,1,x\n"))
    rows = {r.province_code: r for r in ingest.load_annual(raw, NTL_ANNUAL).collect()}
    assert sorted(rows) == ["01", "02"]
    assert (rows["01"].year, rows["01"].sol, rows["01"].source, rows["01"].rad_cv) == (2010, 2.0, "DMSP/VIIRS", 0.5)
    assert rows["02"].sol is None and rows["02"].rad_cv is None and rows["02"].source is None
    report = ingest.load_report(raw, NTL_ANNUAL, ingest.load_annual(raw, NTL_ANNUAL))
    assert report["state"] == "loaded" and report["unused"] == ["nam", "extra"] and "sol" in report["matched"] and "note" in report["missing"]


def test_months(spark, tmp_path):
    raw = ingest.load_indicator_csv(spark, csv(tmp_path, "m.csv", "province_code,year,month,sol\n01,2020,7,1\n01,2020,0,2\n01,2020,13,3\n01,2020,x,3\n"))
    (r,) = ingest.load_monthly(raw, NTL_MONTHLY).collect()
    assert (r.province_code, r.year, r.month, r.sol) == ("01", 2020, 7, 1)


def test_first_usable(spark, tmp_path):
    empty = csv(tmp_path, "e.csv", "province_code,year,sol\n")
    good = csv(tmp_path, "g.csv", "province_code,year,sol\n1,2010,1\n")
    legacy = csv(tmp_path, "l.csv", "ma_tinh,nam,sol_ntl\n1,2010,1\n")
    path, df, report = ingest.first_usable(spark, [str(tmp_path / "none.csv"), empty, good], NTL_ANNUAL)
    assert path == good and df.count() == 1 and report["rows"] == 1
    path, df, report = ingest.first_usable(spark, [legacy, good], NTL_ANNUAL)
    assert path == legacy and df is None and report["state"] == "unreadable" and report["missing_keys"] == ["province_code"]
    assert ingest.first_usable(spark, [empty], NTL_ANNUAL)[2] == {"state": "absent"}
    assert ingest.read_code_compat(ingest.load_indicator_csv(spark, legacy)).first().province_code == "01"


MANIFEST = "province_code string, province_name string, year string, month string, source string, path string, area_km2 string"


def test_manifest(spark):
    good = ("1", "A", "2014", "", "viirs", "a.tif", "10")
    bad = [("123", "A", "2014", "0", "VIIRS", "a.tif", "10"), ("2", "", "2014", "0", "VIIRS", "a.tif", "10"), ("2", "A", "2003", "0", "DMSP", "a.tif", "10"), ("2", "A", "2010", "3", "DMSP", "a.tif", "10"),
           ("3", "A", "2012", "0", "VIIRS", "a.tif", "10"), ("4", "A", "2014", "0", "VIIRS", "a.tif", "inf"), ("5", "A", "2014", "0", "VIIRS", " ", "10"), ("6", "A", "2014", "0", "VIIRS", None, "10")]
    valid, rejects = ingest.validate_manifest(spark.createDataFrame([good, *bad], MANIFEST))
    assert [(r.province_code, r.month, r.source) for r in valid.collect()] == [("01", 0, "VIIRS")] and rejects.count() == len(bad)
    with pytest.raises(ValueError, match="repeated"):
        ingest.validate_manifest(spark.createDataFrame([good, good], MANIFEST), strict=True)
    with pytest.raises(ValueError, match="no such file"):
        ingest.validate_manifest(spark.createDataFrame([good], MANIFEST), spark.createDataFrame([("b.tif",)], "path string"), strict=True)
    with pytest.raises(ValueError, match="without images"):
        ingest.validate_manifest(spark.createDataFrame([], MANIFEST), strict=True)
    with pytest.raises(ValueError, match="columns"):
        ingest.validate_manifest(spark.createDataFrame([good], MANIFEST).drop("path"))


def test_economy(spark):
    schema = "province_code string, year string, population string, grdp string, gdp string, grdp_price_basis string, source string"
    r = ingest.load_economy(spark.createDataFrame([("1", "2014", "", "", "5", " so_sanh ", "x")], schema)).first()
    assert (r.province_code, r.population, r.gdp, r.price_basis) == ("01", None, 5, "so_sanh")
    with pytest.raises(ValueError):
        ingest.load_economy(spark.createDataFrame([("1", "2014", "1", "1", "1", "", "x"), ("01", "2014", "1", "1", "1", "", "x")], schema))
    with pytest.raises(Exception, match="not finite"):
        ingest.load_economy(spark.createDataFrame([("1", "2014", "inf", "1", "1", "", "x")], schema)).collect()


def test_dedupe_and_writer(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], "k string, _seq int, v string")
    assert sorted((r.k, r.v) for r in ingest.dedupe_last(df, ["k"]).collect()) == [("a", "new"), ("b", "x")]
    tables = {"t": df}
    catalogue.write_tables(tables, str(tmp_path / "out"), ["v"])
    assert spark.read.parquet(str(tmp_path / "out/t")).columns == ["v", "_seq", "k"]
    with pytest.raises(FileExistsError):
        catalogue.write_tables({"other": df} | tables, str(tmp_path / "out"))
    assert not (tmp_path / "out/other").exists()
    catalogue.write_tables(tables, str(tmp_path / "out"), overwrite=True)


def test_catalogue_and_boundaries(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps([{"number": 2, "ma_tinh": "2", "ten_tinh": "B", "slug": "b", "gid_1": "g2"}, {"number": 1, "ma_tinh": "01", "ten_tinh": "A", "slug": "a", "gid_1": "g1"}]))
    provinces = catalogue.province_dim(spark, str(path))
    assert [r.province_code for r in provinces.collect()] == ["01", "02"]
    features = spark.createDataFrame([("g1", "A"), ("g2", "B")], "gid_1 string, source_name string")
    walk = spark.createDataFrame([("g1", "A", "1", "A"), ("g2", "B", "2", "B")], "gid_1 string, source_name string, ma_tinh string, ten_tinh string")
    assert catalogue.validate_crosswalk(features, walk, provinces, 2).collect() == []
    off = walk.withColumn("source_name", F.when(F.col("gid_1") == "g2", "b").otherwise(F.col("source_name")))
    assert [r.problem for r in catalogue.validate_crosswalk(features, off, provinces, 2).collect()] == ["names differ"]
    assert {r.problem for r in catalogue.validate_crosswalk(features, walk.limit(1), provinces, 2).collect()} == {"feature not in crosswalk", "province not covered", "number of rows"}
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    geo = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"province_code": "1"}, "geometry": {"type": "Polygon", "coordinates": [square(105.1, 21.5, 0.4)]}},
        {"type": "Feature", "properties": {"ma_tinh": "02"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square(106, 21, 1), square(106.2, 21.2, 0.2)], [square(108, 21, 0.5)]]}}]}
    (tmp_path / "g.geojson").write_text(json.dumps(geo))
    rings = catalogue.load_boundaries(spark, str(tmp_path / "g.geojson"))
    assert catalogue.boundary_problems(rings, provinces, 2).collect() == []
    assert {r.problem for r in catalogue.boundary_problems(rings, provinces.filter("number = 1"), 2).collect()} == {"unknown code"}
    assert [(r.province_code, r.rings, r.vertices) for r in raster.boundary_stats(rings).collect()] == [("02", 3, 15), ("01", 1, 5)]
    assert raster.all_bbox(rings).first().east == 108.5 and raster.code_mismatch(rings, provinces).collect() == []
    cells = raster.assign_province(raster.edges(rings), 104.5, 22.5, 0.1, 20, 20).filter("province_code = '01'")
    assert cells.count() == 16
    hole = raster.assign_province(raster.edges(rings), 105.5, 22.5, 0.1, 20, 40).filter("province_code = '02'")
    assert hole.count() == 100 - 4 + 25


def test_assign_against_ray_casting(spark):
    shapes = {"01": [(1.0, 1.0), (9.0, 2.0), (6.0, 9.0)], "02": [(6.0, 9.0), (9.0, 2.0), (14.0, 11.0), (5.0, 14.0)]}
    rings = spark.createDataFrame([(c, [{"x": x, "y": y} for x, y in p]) for c, p in shapes.items()], "province_code string, ring array<struct<x: double, y: double>>")
    got = {(r.province_code, r.row, r.col) for r in raster.assign_province(raster.edges(rings), 0.0, 15.0, 0.5, 30, 30).collect()}

    def inside(p, x, y):
        n = 0
        for (x1, y1), (x2, y2) in zip(p, p[1:] + p[:1]):
            if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
                n += 1
        return n % 2 == 1

    want = {(c, r, k) for c, p in shapes.items() for r in range(30) for k in range(30) if inside(p, 0.25 + k * 0.5, 15 - 0.25 - r * 0.5)}
    assert got == want
    grid = raster.assign_province(raster.edges(rings), 0.0, 15.0, 0.5, 30, 30)
    area = spark.range(900).select((F.col("id") / 30).cast("int").alias("row"), (F.col("id") % 30).cast("int").alias("col"), F.lit(1.0).alias("pixel_area_km2"))
    assert raster.overlap_audit(grid, area).collect() == []
    more = grid.unionByName(grid.filter("province_code = '01'").limit(3).withColumn("province_code", F.lit("09")))
    assert [tuple(r) for r in raster.overlap_audit(more, area).collect()] == [("01", "09", 3, 3.0)]


def test_mosaic(spark):
    rows = []
    for t, (top, left) in enumerate([(0, 0), (0, 45), (40, 0), (40, 45)]):
        rows += [(r, c, f"t{t}", float(10 + t) if top <= r < top + 40 and left <= c < left + 45 else -9999.0, True) for r in range(80) for c in range(90)]
    df = spark.createDataFrame(rows, "row int, col int, tile string, radiation double, mask boolean")
    out = raster.mosaic(df)
    assert out.count() == 7200 and {r.radiation for r in out.select("radiation").distinct().collect()} == {10, 11, 12, 13}
    view = raster.overview(out.withColumn("mask", F.lit(True)), [40])
    assert view.filter("row = 0 AND col = 0").first().radiation == 10


def test_overviews_and_mosaics_of_each_image(spark):
    rows = [(y, r, c, "a" if c < 5 else "b", float(r * c + y), (r + c) % 3 > 0) for y in (1, 2) for r in range(9) for c in range(9)]
    df = spark.createDataFrame(rows, "year int, row int, col int, tile string, radiation double, mask boolean")
    got = {(x.year, x.factor, x.row, x.col): (x.radiation, x.n) for x in raster.overview(df, [2, 4, 6], ["year"]).collect()}
    want: dict = {}
    for y, r, c, _, v, ok in rows:
        for k in (2, 4, 6) if ok else ():
            want.setdefault((y, k, r // k, c // k), []).append(v)
    assert got == {k: (round(sum(v) / len(v), 6), len(v)) for k, v in want.items()}
    assert raster.mosaic(df, keys=["year"]).count() == 2 * sum((r + c) % 3 > 0 for r in range(9) for c in range(9))


def test_rings_of_cells(spark):
    cells = [("01", 0, 0), ("01", 0, 1), ("01", 0, 3), ("01", 2, 5), ("02", 1, 1)]
    df = spark.createDataFrame(cells, "province_code string, row int, col int")
    rings = raster.rings_of_cells(df.union(df))
    assert [(r.province_code, r.rings, r.vertices) for r in raster.boundary_stats(rings).collect()] == [("01", 3, 15), ("02", 1, 5)]
    assert tuple(raster.all_bbox(rings).first()) == (0.0, -3.0, 6.0, 0.0)
    shifted = raster.assign_province(raster.edges(rings), 0.0, 0.0, 1.0, 4, 8)
    assert {tuple(r) for r in shifted.select("province_code", "row", "col").collect()} == set(cells)


def test_calibration_needs_thirty_regions(spark):
    from lumenfield.operators import models

    pairs = spark.createDataFrame([(float(i + 1), 2.0 * (i + 1)) for i in range(30)], "sol_dmsp double, sol_viirs double")
    assert models.fit_calibration(pairs).first()["beta"] == pytest.approx(1)
    with pytest.raises(ValueError):
        models.fit_calibration(pairs.limit(29))
    with pytest.raises(ValueError):
        models.fit_calibration(pairs.withColumn("sol_viirs", 1 / F.col("sol_dmsp")))


def test_inventories(spark):
    files = spark.createDataFrame([(f"/d/{f}", 1) for f in ["raw/p1_VIIRS_2020-01.tif", "filtered/p1_VIIRS_2020-01.tif", "raw/p2_VIIRS_2020-02_x.tif", "raw/p_VIIRS_2020-13.tif"]], "path string, size_bytes long")
    rows = catalogue.image_inventory(files, expected=1).collect()
    assert [(r.year, r.month, r.n, r.paths) for r in rows] == [(2020, 1, 1, ["/d/filtered/p1_VIIRS_2020-01.tif"]), (2020, 2, 1, ["/d/raw/p2_VIIRS_2020-02_x.tif"])]
    annual = spark.createDataFrame([("/d/b_2010.tif", 1), ("/d/a_2010_v2.tif", 2), ("/d/a_2011.tif", 3), ("/d/c.tif", 4)], "path string, size_bytes long")
    assert [(r.year, r.size_bytes) for r in catalogue.annual_image_inventory(annual, ["^a_", "^b_"]).collect()] == [(2010, 2), (2011, 3)]
    images = spark.createDataFrame([("NTL", 2011, 0, "a", 1), ("NTL", 2010, 0, "b", 2), ("NTL", 2010, 3, "c", 3), ("NTL", 2010, 0, "d", 4), ("DAY", 2010, 0, "e", 5)], "kind string, year int, month int, path string, _seq int")
    known = catalogue.register_images(images)
    assert [r.path for r in catalogue.image_registry(known, "NTL").collect()] == ["d", "a"]
    assert [r.path for r in catalogue.image_registry(known, "NTL", "monthly").collect()] == ["c"] and catalogue.image_path(known, "NTL", 2010, 3).first().path == "c"
    assert [tuple(r) for r in catalogue.image_counts(known).collect()] == [("DAY", 1, 0), ("NTL", 2, 1)]
