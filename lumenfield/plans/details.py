"""Registered queries of what other queries only touch: every verdict on a manifest, boundary problems, contents of exports, refusals, manifests with tags and projected pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfield.functions.columns import pixel_area_km2
from lumenfield.operators import export, panel, quality, shaping, tables, timefn, zonal
from lumenfield.plans import inputs, places
from lumenfield.plans import sql as S
from lumenfield.plans.base import query
from lumenfield.sources import adapter as A
from lumenfield.sources import catalogue, ingest
from lumenfield.sources.shared import shared_path

#: What is wrong with the manifest's rows, by the number of shipments that an image stands for.
_FAULTS = (
    (0, "a cell is missing"), (1, "province code or name"), (2, "province code or name"), (3, "year or month out of range"), (4, "year or month out of range"), (5, "source does not fit the period"), (6, "source does not fit the period"),
    (7, "source does not fit the period"), (8, "area_km2 must be positive and finite"), (9, "area_km2 must be positive and finite"), (10, "repeated image"), (11, "no path"), (12, "no such file"),
)
_VERDICTS = " ".join(f"WHEN {k} THEN '{said}'" for k, said in _FAULTS)


@query(f"""WITH k AS (SELECT s_nationkey AS n, year(l_shipdate) + 14 AS y, month(l_shipdate) AS m, count(*) % 16 AS k FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE year(l_shipdate) + 14 >= 2013 GROUP BY ALL)
    SELECT CASE k {_VERDICTS} ELSE 'ok' END AS verdict, count(*) * CASE k WHEN 10 THEN 2 ELSE 1 END AS images, k FROM k GROUP BY k""")
def manifest_verdicts(spark, d):
    """A manifest of monthly images in which every rule is broken by some rows."""
    rows = inputs.shipments(spark, d).filter(F.year("l_shipdate") + 14 >= 2013).groupBy(F.col("s_nationkey").alias("n"), (F.year("l_shipdate") + 14).alias("y"), F.month("l_shipdate").alias("m")).agg((F.count("*") % 16).cast("int").alias("k"))
    k, text = F.col("k"), lambda c: F.col(c).cast("string")
    path = F.concat_ws("_", F.lit("/images/p"), "n", "y", "m")
    made = rows.select(
        "k", F.when(k == 1, "1a2").otherwise(F.concat(F.lit(" "), text("n"))).alias("province_code"), F.when(k == 2, " ").otherwise(F.concat(F.lit("nation "), text("n"))).alias("province_name"),
        F.when(k == 0, None).when(k == 3, "2003").otherwise(text("y")).alias("year"), F.when(k == 4, "13").otherwise(text("m")).alias("month"),
        F.when(k == 5, "LANDSAT").when(k == 6, "DMSP").when(k == 7, "").otherwise(" viirs ").alias("source"), F.when(k == 11, " ").otherwise(path).alias("path"),
        F.when(k == 8, "0").when(k == 9, "NaN").otherwise("12.5").alias("area_km2"), F.explode(F.when(k == 10, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).drop("again")
    there = rows.filter("k != 12").select(path.alias("path"))
    valid, rejects = ingest.validate_manifest(made, there)
    said = valid.select("k", F.lit("ok").alias("verdict")).unionByName(rejects.select("k", F.col("error").alias("verdict")))
    return said.groupBy("k", "verdict").agg(F.count("*").alias("images")).select(F.col("k").cast("long").alias("k"), "verdict", "images")


@query(f"""WITH {S.PROV}, r AS (SELECT DISTINCT c_nationkey AS n FROM customer), f AS (SELECT n, CASE WHEN n % 9 = 4 THEN 'Z' || n ELSE lpad(CAST(n AS VARCHAR), 2, '0') END AS code FROM r WHERE n % 8 <> 5)
    SELECT 'number of features' AS problem, CAST(count(*) AS VARCHAR) AS province_code FROM f HAVING count(*) <> 63 UNION ALL SELECT 'out of bounds', code FROM f WHERE n % 7 = 2
    UNION ALL SELECT 'unknown code', code FROM f WHERE n % 9 = 4 UNION ALL SELECT 'not covered', province_code FROM prov WHERE province_code NOT IN (SELECT code FROM f)""")
def boundary_problems(spark, d):
    """Boundaries of which some are missing, some lie far off and some have codes that no catalogue knows."""
    n = F.col("province_code").cast("int")
    rings = places.stars(spark, d).filter(n % 8 != 5)
    away = F.when(n % 7 == 2, F.transform("ring", lambda p: F.struct(p["x"].alias("x"), (p["y"] + 30).alias("y")))).otherwise(F.col("ring"))
    rings = rings.select(F.when(n % 9 == 4, F.concat(F.lit("Z"), n)).otherwise(F.col("province_code")).alias("province_code"), away.alias("ring"))
    return catalogue.boundary_problems(rings, A.provinces(spark, d))


def _image_meta(spark, d):
    """Every annual VIIRS image that a nation could have, with a tag, a path and a number of bands; some were never taken."""
    own = A.provinces(spark, d).select("province_code", "province_name", "area_km2", "number")
    rows = own.withColumn("year", F.explode(F.sequence(F.lit(2013), F.lit(2016))))
    n = F.col("number")
    return rows.select(
        "province_code", "province_name", "year", F.lit(0).alias("month"), F.lit("VIIRS").alias("source"), F.concat_ws("_", F.lit("viirs"), "province_code", "year").alias("path"), "area_km2",
        F.when(n % 3 == 0, F.lit(float("nan"))).otherwise(n / 8.0).alias("cf_cvg_mean_tag"), (n % 2 + 1).cast("int").alias("band_count"),
    )


def _tagged(spark, d):
    """Pixels of VIIRS years, those of odd nations without observation counts and in metres, those of the third nation masked."""
    n = F.col("province_code").cast("int")
    area = pixel_area_km2(F.when(n % 2 == 1, 463.83).otherwise(0.004), F.when(n % 2 == 1, -463.83).otherwise(-0.004), F.when(n % 2 == 1, 32648).otherwise(4326), F.col("lat"))
    pixel = A.pixels(spark, d).filter("source = 'VIIRS'")
    return pixel.withColumns({"cf_cvg": F.when(n % 2 == 0, F.col("cf_cvg")), "pixel_area_km2": area, "mask": F.col("mask") & (n != 3)})


_TAGGED = f"""{S.PIXELS}, meta AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_code, n_nationkey + 1 AS k, y AS year FROM nation CROSS JOIN range(2013, 2017) r(y)),
    v AS (SELECT *, mask AND province_code <> '03' AS ok, CAST(province_code AS INT) % 2 = 1 AS metres FROM pixel WHERE source = 'VIIRS'),
    z AS (SELECT province_code, year, count(*) FILTER (ok) AS n, sum(radiation) FILTER (ok) AS raw, count(*) FILTER (ok AND radiation >= 1.5) AS lit, sum(CASE WHEN metres THEN 463.83::DOUBLE * 463.83 / 1e6 ELSE area END) FILTER (ok AND radiation >= 1.5) AS lit_area,
        avg(CASE WHEN NOT metres THEN cf END) FILTER (ok) AS cloud FROM v GROUP BY ALL)"""


@query(f"""{_TAGGED} SELECT meta.province_code, meta.year, coalesce(n, 0) AS valid_pixels, CASE WHEN n > 0 THEN round(raw, 4) END AS sol_raw, CASE WHEN n > 0 THEN lit END AS lit_pixels, CASE WHEN n > 0 THEN round(coalesce(lit_area, 0), 4) END AS lit_area_km2,
    round(coalesce(cloud, CASE WHEN k % 3 <> 0 THEN k / 8.0 END), 4) AS cloud_free_obs, CASE WHEN n > 0 THEN 'OK' ELSE 'INSUFFICIENT_QUALITY' END AS status,
    CASE WHEN coalesce(n, 0) = 0 THEN 'L' WHEN meta.year = 2014 THEN 'B' WHEN coalesce(cloud, CASE WHEN k % 3 <> 0 THEN k / 8.0 END) < 2 THEN 'U' ELSE 'A' END AS obs_status
    FROM meta LEFT JOIN z ON z.province_code = meta.province_code AND z.year = meta.year""")
def zonal_with_manifest(spark, d):
    """Statistics of every image of a manifest: images without a valid pixel, tags in place of observation counts, and pixels in metres."""
    out = zonal.zonal_stats(_tagged(spark, d), image_meta=_image_meta(spark, d))
    out = quality.obs_status(zonal.with_area(out))
    return out.select("province_code", "year", "valid_pixels", "sol_raw", "lit_pixels", "lit_area_km2", "cloud_free_obs", "status", "obs_status")


@query(f"""{_TAGGED} SELECT 'G.' || meta.province_code AS gid_1, meta.year, 'viirs_' || meta.province_code || '_' || meta.year || '#band=1' AS avg_rad, CASE WHEN k % 2 + 1 = 2 THEN 'viirs_' || meta.province_code || '_' || meta.year || '#band=2' END AS cf_cvg,
    coalesce(n, 0) AS total_pixels, CASE WHEN n > 0 THEN round(raw, 4) END AS tnl FROM meta LEFT JOIN z ON z.province_code = meta.province_code AND z.year = meta.year""")
def night_data_bands(spark, d):
    """The night dictionary with references to the bands of each image."""
    rows = zonal.zonal_stats(_tagged(spark, d), image_meta=_image_meta(spark, d))
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in ("tnl_ma3", "tnl_mom_growth_pct")})
    return tables.night_data(rows, A.provinces(spark, d)).select("gid_1", "year", "avg_rad", "cf_cvg", "total_pixels", "tnl")


@query(f"""{S.ANNUAL}, i(indicator) AS (VALUES ('sol'), ('sol_cal')), y AS (SELECT province_code, min(year) AS lo, max(year) AS hi FROM ac WHERE year BETWEEN 2005 AND 2005 + CAST(province_code AS INT) % 13 GROUP BY ALL)
    SELECT province_code, indicator, concat_ws('; ', CASE WHEN lo < 2010 AND hi >= 2010 THEN '{quality.REFUSED[2010]}' END, CASE WHEN lo < 2014 AND hi >= 2014 AND indicator <> 'sol_cal' THEN '{quality.REFUSED[2014]}' END) AS refused FROM y CROSS JOIN i""")
def refused_reasons(spark, d):
    """Why changes over a period are refused, where each nation asks for a period of its own."""
    until = 2005 + F.col("province_code").cast("int") % 13
    rows = A.annual(spark, d, True).filter(F.col("year").between(F.lit(2005), until)).select("province_code", F.col("year").cast("string").alias("period"), F.inline(F.array(*(F.struct(F.lit(c).alias("indicator"), F.col(c).alias("value")) for c in ("sol", "sol_cal")))))
    return timefn.time_functions(rows, ["cagr"]).select("province_code", "indicator", F.array_join("refused", "; ").alias("refused"))


@query("""WITH r AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN ' sol , gdp' WHEN 1 THEN 'sol;gdp' WHEN 2 THEN '' WHEN 3 THEN ' , ' WHEN 4 THEN 'NDVI_mean,,sol_ma3' ELSE 'sol,' || c_mktsegment END AS indicators FROM customer)
    SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'sol|gdp' WHEN 4 THEN 'NDVI_mean|sol_ma3' END AS accepted FROM r""")
def panel_requests(spark, d):
    """Requests of customers for indicators: known ones are taken, and a request with an unknown one, or none, is refused."""
    k = F.col("c_custkey") % 6
    asked = F.when(k == 0, " sol , gdp").when(k == 1, "sol;gdp").when(k == 2, "").when(k == 3, " , ").when(k == 4, "NDVI_mean,,sol_ma3").otherwise(F.concat(F.lit("sol,"), "c_mktsegment"))
    out = panel.checked_requests(A.table(spark, d, "customer").select("c_custkey", asked.alias("indicators")))
    return out.select("c_custkey", F.array_join("accepted", "|").alias("accepted"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 < 2 AND contains(CAST(c_custkey AS VARCHAR), '7')")
def search_accents(spark, d):
    """A search without accents and in another case among names with them, one for each customer."""
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 4 == 0, "Đà Nẵng ").when(k % 4 == 1, "ĐÀ NẴNG ").when(k % 4 == 2, "Hà Nội ").otherwise("Da Lat "), F.regexp_replace(k.cast("string"), "7", " 7 "))
    # the digit is set off, so that the search text has to be found inside the name
    named = A.table(spark, d, "customer").select("c_custkey", F.concat(F.when(k.cast("string").contains("7"), "x 7 ").otherwise(""), name).alias("province_name"))
    both = shaping.search_province(named, " dA naNG ").join(shaping.search_province(named, "X 7"), "c_custkey", "left_semi")
    return both.select("c_custkey")


@query(f"{S.ANNUAL} SELECT province_code, year, sol, 1 AS kept, (SELECT count(DISTINCT province_code) FROM ac) AS total FROM ac WHERE province_code = '11'")
def limit_series_focus(spark, d):
    """More series than fit, with one in focus."""
    rows = A.annual(spark, d).select("province_code", "province_name", "year", "sol")
    return shaping.limit_series(rows, 8, "11").select("province_code", "year", "sol", "kept", "total")


_LEGEND = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in quality.FLAGS.items())


@query(f"{S.ANNUAL} SELECT province_code, year, source, CASE obs_status {_LEGEND} END AS flag_text FROM ac")
def flag_texts(spark, d):
    """What each row's flag means."""
    return quality.explained(A.annual(spark, d)).select("province_code", "year", "source", "flag_text")


_CODES, _PERIODS = ["sol", "rad_cv"], ["2012", "2013", "2014"]


def _quoted(lines):
    return ", ".join("(" + str(i) + ", '" + x.replace("'", "''") + "')" for i, x in enumerate(lines, 1))


@query(f"""{S.ANNUAL}, said(line, text) AS (VALUES {_quoted([*export.panel_notes(_CODES, _PERIODS), "", "province_code,province_name,indicator,unit,source,2012,2013,2014"])}),
    src AS (SELECT province_code, string_agg(DISTINCT source, '/' ORDER BY source) AS source FROM ac WHERE year BETWEEN 2012 AND 2014 GROUP BY ALL),
    rows AS (SELECT p.province_code, p.province_name, p.number, i.indicator, i.k, any_value(src.source) AS source, {", ".join(f"round(max(CASE i.indicator WHEN 'sol' THEN sol ELSE rad_cv END) FILTER (year = {y}), 4) AS v{y}" for y in _PERIODS)}
        FROM prov p CROSS JOIN (VALUES ('sol', 0), ('rad_cv', 1)) i(indicator, k) LEFT JOIN ac ON ac.province_code = p.province_code AND year BETWEEN 2012 AND 2014 LEFT JOIN src ON src.province_code = p.province_code GROUP BY ALL)
    SELECT line, text AS head, NULL::DOUBLE AS v2012, NULL::DOUBLE AS v2013, NULL::DOUBLE AS v2014 FROM said
    UNION ALL SELECT (SELECT count(*) FROM said) + row_number() OVER (ORDER BY number, k), concat_ws(',', province_code, province_name, indicator, CASE indicator WHEN 'sol' THEN 'nW/cm2/sr' ELSE '1' END, coalesce(source, '')), v2012, v2013, v2014 FROM rows""")
def export_panel_lines(spark, d):
    """Every line of the wide panel's file in its order: the notes, the header, and the rows, whose numbers are read back."""
    path = shared_path(spark, "wide")
    long = panel.panel_long(A.tables(spark, d, "ntl_annual"), A.provinces(spark, d), _CODES, _PERIODS)
    export.export_panel_csv(long, path, "rong", _CODES, _PERIODS)
    # one file of as many lines as the request has rows
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "^\\uFEFF|\\n$", ""), "\n")).alias("i", "text"))
    cells = F.split("text", ",")
    row = F.size(cells) >= 8
    row = row & ~F.startswith("text", F.lit("province_code,")) & ~F.startswith("text", F.lit("#"))
    value = lambda i: F.when(row, F.round(F.nullif(F.get(cells, F.lit(i)), F.lit("")).cast("double"), 4))
    head = F.when(row, F.array_join(F.slice(cells, 1, 5), ",")).otherwise(F.col("text"))
    return text.select((F.col("i") + 1).cast("long").alias("line"), head.alias("head"), *(value(5 + i).alias(f"v{y}") for i, y in enumerate(_PERIODS)))


@query(f"""{S.ANNUAL_AND_ECONOMY}, day AS ({S.DAY_ROWS}), {inputs.ENTRIES.replace('images AS', 'pictures AS')}, own AS (SELECT * FROM ac WHERE province_code = '05' AND year BETWEEN 2007 AND 2014),
    w AS (SELECT min(year) <= 2009 AND max(year) >= 2010 AS crosses, count(DISTINCT source) > 1 AS mixed FROM own),
    gaps AS (SELECT 'light' AS part, 'no light rows in 2007-2014' AS said FROM own HAVING count(*) = 0 UNION ALL SELECT 'day', 'no day rows in 2007-2014' FROM day WHERE province_code = '05' AND year BETWEEN 2007 AND 2014 HAVING count(*) = 0
        UNION ALL SELECT 'economy', 'no economy rows in 2007-2014' FROM econ WHERE province_code = '05' AND year BETWEEN 2007 AND 2014 HAVING count(*) = 0 UNION ALL SELECT 'images', 'no images of these years' FROM pictures WHERE month = 0 AND year BETWEEN 2007 AND 2014 HAVING count(*) = 0)
    SELECT 'light' AS part, CAST(year AS VARCHAR) AS item, source AS detail, round(sol, 4) AS value FROM own UNION ALL SELECT 'day', CAST(year AS VARCHAR), 'S2', round(ndvi, 4) FROM day WHERE province_code = '05' AND year BETWEEN 2007 AND 2014
    UNION ALL SELECT 'economy', CAST(year AS VARCHAR), 'orders', round(population, 4) FROM econ WHERE province_code = '05' AND year BETWEEN 2007 AND 2014 UNION ALL SELECT 'images', CAST(year AS VARCHAR), kind || ' i' || seq, NULL FROM pictures WHERE month = 0 AND year BETWEEN 2007 AND 2014
    UNION ALL SELECT 'notes', topic, detail, NULL FROM (SELECT 'province' AS topic, '05 ' || n_name AS detail FROM nation WHERE n_nationkey = 5 UNION ALL VALUES ('years', '2007-2014'), {", ".join(f"('file', '{x}')" for x in export.BUNDLE_FILES)}, {", ".join(f"('sensor', '{x}')" for x in export.IMAGES)})
    UNION ALL SELECT 'notes', 'caution', '{quality.BREAK_2010}', NULL FROM w WHERE crosses UNION ALL SELECT 'notes', 'caution', '{quality.USE_CALIBRATED}', NULL FROM w WHERE mixed
    UNION ALL SELECT 'notes', 'gap', said, NULL FROM gaps UNION ALL SELECT part, '# ' || said, NULL, NULL FROM gaps""")
def export_bundle_contents(spark, d):
    """What the files of a province's bundle say, read back."""
    path = shared_path(spark, "bundle")
    export.export_bundle(A.provinces(spark, d), A.annual(spark, d, True), inputs.day_rows(spark, d), A.economy(spark, d), inputs.images(spark, d), "05", path, 2007, 2014)
    read = lambda part: spark.read.option("header", True).option("escape", '"').csv(f"{path}/{part}")
    show = lambda part, item, detail, value: read(part).select(F.lit(part).alias("part"), F.col(item).alias("item"), detail.alias("detail"), value.alias("value"))
    number = lambda c: F.round(F.col(c).cast("double"), 4)
    none = F.lit(None).cast("double")
    out = show("light", "year", F.col("source"), number("sol")).unionByName(show("day", "year", F.col("source"), number("NDVI_mean"))).unionByName(show("economy", "year", F.col("source"), number("population")))
    return out.unionByName(show("images", "year", F.concat_ws(" ", "kind", "path"), none)).unionByName(show("notes", "topic", F.col("detail"), none))
