"""Registered queries of the sources: files that Spark derives from the given tables, written to the shared folder and loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.plans import sql as S
from lumenfield.plans.base import query
from lumenfield.schemas import DAY_ANNUAL, NTL_ANNUAL, NTL_MONTHLY
from lumenfield.sources import adapter as A
from lumenfield.sources import catalogue, ingest, store
from lumenfield.sources.shared import shared_path


def written_csv(df: DataFrame, name: str) -> str:
    """All columns as text in a CSV with a header below the shared folder."""
    path = shared_path(df.sparkSession, name)
    df.select(*(F.col(c).cast("string").alias(c) for c in df.columns)).write.option("header", True).option("emptyValue", "").csv(path)
    return path


def written_text(df: DataFrame, name: str) -> str:
    """One column of text, a row a line."""
    path = shared_path(df.sparkSession, name)
    df.write.text(path)
    return path


def shipments(spark, d) -> DataFrame:
    line, supplier = A.table(spark, d, "lineitem"), A.table(spark, d, "supplier")
    return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))


#: Shipments by nation, year, flag and month: what a provider of indicators would send, with cells that stand for no number.
SENT = """sent AS (SELECT CAST(s_nationkey AS VARCHAR) AS code, year(l_shipdate) + 14 AS y, l_returnflag AS flag, month(l_shipdate) AS mo, count(*) AS k, CAST(sum(l_quantity) AS BIGINT) AS q
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""


def sent(spark, d) -> DataFrame:
    rows = shipments(spark, d).groupBy(F.col("s_nationkey").cast("string").alias("code"), (F.year("l_shipdate") + 14).alias("y"), F.col("l_returnflag").alias("flag"), F.month("l_shipdate").alias("mo"))
    return rows.agg(F.count("*").alias("k"), F.sum("l_quantity").cast("long").alias("q"))


@query(f"""WITH {SENT}, r AS (SELECT lpad(code, 2, '0') AS province_code, y, flag, CASE WHEN k % 5 <> 0 THEN CAST(q AS DOUBLE) END AS v FROM sent WHERE k % 7 <> 0)
    SELECT province_code, y AS year, string_agg(DISTINCT flag, '/' ORDER BY flag) AS source, round(avg(v), 6) AS sol FROM r GROUP BY ALL""")
def csv_annual(spark, d):
    """A file of several rows a year, without a month column, with the year under its other name, sentinels, and rows without a code."""
    rows = sent(spark, d)
    code = F.when(F.col("k") % 7 != 0, F.concat(F.lit(" "), "code")).otherwise("")
    path = written_csv(rows.select(code.alias("province_code"), F.col("y").alias("nam"), F.col("flag").alias("source"), F.when(F.col("k") % 5 != 0, F.col("q").cast("string")).otherwise("NA").alias("sol"), "mo"), "annual")
    out = ingest.load_annual(ingest.load_indicator_csv(spark, path), NTL_ANNUAL)
    return out.select("province_code", "year", "source", "sol")


@query(f"""WITH {SENT} SELECT lpad(code, 2, '0') AS province_code, y AS year, mo AS month, flag AS source, CAST(q AS DOUBLE) AS sol FROM sent WHERE k % 3 <> 0""")
def csv_monthly(spark, d):
    """A file of months, where some rows have a month that is no number or none of the twelve."""
    rows = sent(spark, d)
    month = F.when(F.col("k") % 3 != 0, F.col("mo").cast("string")).when(F.col("k") % 2 == 0, "13").otherwise("x")
    path = written_csv(rows.select(F.col("code").alias("province_code"), F.col("y").alias("year"), month.alias("month"), F.col("flag").alias("source"), F.col("q").alias("sol")), "monthly")
    return ingest.load_monthly(ingest.load_indicator_csv(spark, path), NTL_MONTHLY).select("province_code", "year", "month", "source", "sol")


@query(f"""WITH {SENT}, r AS (SELECT lpad(code, 2, '0') AS province_code, y AS year, round(avg(q), 6) AS sol FROM sent GROUP BY ALL)
    SELECT province_code, year, sol, 'loaded' AS state, (SELECT count(*) FROM r) AS rows, 'province_code,year,sol' AS matched, 'extra' AS unused, CAST(count(*) OVER () AS BIGINT) AS loaded FROM r""")
def csv_first_usable(spark, d):
    """The third candidate: the first doesn't exist and the second has no rows. The report of its columns is beside each row."""
    rows = sent(spark, d).select(F.col("code").alias("province_code"), F.col("y").alias("year"), F.col("q").alias("sol"), F.lit("?").alias("extra"))
    empty, good = written_csv(rows.filter("sol < 0").coalesce(1), "empty"), written_csv(rows, "good")
    _, usable, report = ingest.first_usable(spark, [empty + "-none", empty, good], NTL_ANNUAL)
    said = {"state": report["state"], "rows": report["rows"], "matched": ",".join(report["matched"]), "unused": ",".join(report["unused"])}
    out = usable.select("province_code", "year", "sol", *(F.lit(v).alias(k) for k, v in said.items()))
    return out.withColumns({"rows": F.col("rows").cast("long"), "loaded": F.lit(usable.count())})


@query(f"""WITH {SENT}, k AS (SELECT DISTINCT code, y FROM sent) SELECT 'unreadable' AS state, count(*) AS rows, 'province_code' AS missing_keys, 'ma_tinh,nam,sol_ntl' AS headers FROM k""")
def csv_unreadable(spark, d):
    """A file of the legacy layout has rows, but none that can be used; the report says what it lacks."""
    rows = sent(spark, d).select(F.col("code").alias("ma_tinh"), F.col("y").alias("nam"), F.lit(1).alias("sol_ntl")).distinct()
    _, _, report = ingest.first_usable(spark, [written_csv(rows, "legacy")], NTL_ANNUAL)
    return rows.limit(1).select(
        F.lit(report["state"]).alias("state"), F.lit(report["rows"]).cast("long").alias("rows"), F.lit(",".join(report["missing_keys"])).alias("missing_keys"), F.lit(",".join(report["headers"])).alias("headers")
    )  # one row: what the report says


@query(f"""WITH {SENT} SELECT DISTINCT lpad(code, 2, '0') AS province_code, y AS year FROM sent""")
def csv_legacy_codes(spark, d):
    """Codes under the legacy name are read too where that is asked for."""
    path = written_csv(sent(spark, d).select(F.col("code").alias("ma_tinh"), F.col("y").alias("year")).distinct(), "codes")
    out = ingest.read_code_compat(ingest.load_indicator_csv(spark, path))
    return out.select("province_code", F.col("year").cast("int").alias("year"))


@query(f"WITH {S.PROV}, {S.ECONOMY} SELECT province_code, year, CASE WHEN year % 3 <> 0 THEN population END AS population, round(grdp, 2) AS gdp, CASE WHEN year % 2 = 0 THEN 'so_sanh' ELSE '' END AS price_basis, 'orders' AS economy_source FROM econ")
def csv_economy(spark, d):
    """An economy file with GRDP in one column or the other, blanks for missing numbers and spaces around the price basis."""
    rows = A.economy(spark, d)
    even = F.col("year") % 2 == 0
    text = F.col("grdp").cast("decimal(20,2)").cast("string")
    sent = rows.select(
        F.col("province_code").cast("int").alias("province_code"), "year", F.when(F.col("year") % 3 != 0, F.col("population").cast("string")).otherwise("").alias("population"),
        F.when(even, text).otherwise("").alias("grdp"), F.when(~even, text).otherwise("").alias("gdp"), F.when(even, " so_sanh ").otherwise(" ").alias("grdp_price_basis"), "source",
    )
    out = ingest.load_economy(spark.read.option("header", True).csv(written_csv(sent, "economy")))
    return out.withColumn("gdp", F.round("gdp", 2))


@query("""SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_code, CAST(n_nationkey + 1 AS INT) AS number, n_name AS province_name, lower(n_name) AS slug, 'G.' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS gid_1, count(s_suppkey) AS suppliers
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL""")
def province_catalogue(spark, d):
    """The JSON catalogue of the provinces, read back and joined to the suppliers of each."""
    p = A.provinces(spark, d)
    entry = F.struct("number", F.col("province_code").cast("int").alias("ma_tinh"), F.col("province_name").alias("ten_tinh"), "slug", "gid_1")
    path = written_text(p.agg(F.to_json(F.collect_list(entry)).alias("value")), "provinces")  # a row a province
    suppliers = A.table(spark, d, "supplier").groupBy(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("province_code")).agg(F.count("*").alias("suppliers"))
    return catalogue.province_dim(spark, path).join(suppliers, "province_code", "left").withColumn("suppliers", F.coalesce("suppliers", F.lit(0)))


@query("""WITH s AS (SELECT DISTINCT s_nationkey AS k FROM supplier), n AS (SELECT n_nationkey AS k, n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code FROM nation)
    SELECT 'names differ' AS problem, 'G.' || code AS key FROM n JOIN s USING (k) WHERE k % 7 = 3
    UNION ALL SELECT 'feature not in crosswalk', 'G.' || code FROM n JOIN s USING (k) WHERE k % 11 = 5
    UNION ALL SELECT 'province not covered', code FROM n WHERE k % 11 = 5
    UNION ALL SELECT 'crosswalk without feature', 'G.' || code FROM n WHERE k % 11 <> 5 AND k NOT IN (SELECT k FROM s)
    UNION ALL SELECT 'number of rows', CAST(count(*) AS VARCHAR) FROM n WHERE k % 11 <> 5""")
def crosswalk_problems(spark, d):
    """Features are the nations that have suppliers; some names differ and some provinces are missing from the crosswalk."""
    p = A.provinces(spark, d)
    k = F.col("province_code").cast("int")
    seen = A.table(spark, d, "supplier").select(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("province_code")).distinct()
    features = p.join(seen, "province_code", "left_semi").select("gid_1", F.when(k % 7 == 3, F.upper(F.concat("province_name", F.lit("?")))).otherwise(F.col("province_name")).alias("source_name"))
    walk = p.filter(k % 11 != 5).select("gid_1", F.col("province_name").alias("source_name"), F.col("province_code").alias("ma_tinh"), F.col("province_name").alias("ten_tinh"))
    return catalogue.validate_crosswalk(features, walk, p, 25)


#: The cells that have pixels of a province, on the grid of 64 x 64.
CELLS = """cells AS (SELECT DISTINCT province_code, "row", col FROM pixel)"""


def cells(spark, d) -> DataFrame:
    return A.pixels(spark, d).select("province_code", "row", "col").distinct()


@query(f"""{S.PIXELS}, {CELLS}, b AS (SELECT province_code, 100 + min(col) * 0.25 AS west, 100 + (max(col) + 1) * 0.25 AS east, 6 + min("row") * 0.25 AS south, 6 + (max("row") + 1) * 0.25 AS north FROM cells GROUP BY ALL)
    SELECT province_code, CASE WHEN CAST(province_code AS INT) % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS shape, 5 AS points, west, south, east, north FROM b""")
def boundaries(spark, d):
    """A GeoJSON file with the bounds of each province's pixels, polygons and multipolygons by turns, loaded again."""
    b = cells(spark, d).groupBy("province_code").agg(
        (100 + F.min("col") * 0.25).alias("w"), (100 + (F.max("col") + 1) * 0.25).alias("e"), (6 + F.min("row") * 0.25).alias("s"), (6 + (F.max("row") + 1) * 0.25).alias("n")
    )
    ring = F.array(*(F.array(F.col(x), F.col(y)) for x, y in ("ws", "es", "en", "wn", "ws")))
    even = F.col("province_code").cast("int") % 2 == 0
    shape = F.when(even, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates"))))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"province_code":"'), "province_code", F.lit('"},"geometry":'), shape, F.lit("}"))
    whole = b.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))  # a row a province
    rings = catalogue.load_boundaries(spark, written_text(whole, "boundaries"))
    p = rings.select("province_code", "shape", F.size("ring").alias("points"), F.explode("ring").alias("p"))
    return p.groupBy("province_code", "shape", "points").agg(F.min("p.x").alias("west"), F.min("p.y").alias("south"), F.max("p.x").alias("east"), F.max("p.y").alias("north"))


FILES = """files AS (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 'filtered' ELSE 'raw' END AS folder, s_nationkey AS k, year(l_shipdate) + 14 AS y, month(l_shipdate) AS mo, lower(l_returnflag) AS mode FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


@query(f"""WITH {FILES}, f AS (SELECT DISTINCT folder, k, y, mo FROM files), n AS (SELECT y, mo, bool_or(folder = 'filtered') AS own FROM f GROUP BY ALL)
    SELECT y AS year, mo AS month, count(*) AS n, count(*) >= 25 AS complete FROM f JOIN n USING (y, mo) WHERE folder = 'filtered' OR NOT own GROUP BY ALL""")
def image_inventory(spark, d):
    """Monthly images by nation, as the names of files in two folders."""
    month = F.format_string("%d-%02d", F.year("l_shipdate") + 14, F.month("l_shipdate"))
    folder = F.when(F.col("l_linenumber") == 1, "filtered").otherwise("raw")
    path = F.concat(F.lit("/data/"), folder, F.lit("/p"), F.col("s_nationkey"), F.lit("_VIIRS_"), month, F.lit(".tif"))
    files = shipments(spark, d).select(path.alias("path"), F.lit(1).alias("size_bytes")).distinct()
    return catalogue.image_inventory(files, expected=25).select("year", "month", F.col("n").cast("long").alias("n"), "complete")


@query(f"""WITH {FILES}, f AS (SELECT DISTINCT y, mode, CASE mode WHEN 'r' THEN 0 WHEN 'a' THEN 1 END AS rank FROM files), r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY rank) AS p FROM f WHERE rank IS NOT NULL)
    SELECT y AS year, '/data/' || mode || '_' || y || '_v1.tif' AS path FROM r WHERE p = 1""")
def annual_image_inventory(spark, d):
    path = F.concat(F.lit("/data/"), F.lower("l_returnflag"), F.lit("_"), F.year("l_shipdate") + 14, F.lit("_v1.tif"))
    files = shipments(spark, d).select(path.alias("path"), F.lit(1).alias("size_bytes")).distinct()
    return catalogue.annual_image_inventory(files, ["^r_", "^a_"]).select("year", "path")


#: Every shipment as an entry of an image; the last one of a kind, year and month counts. Months above six are annual images.
ENTRIES = """entries AS (SELECT l_returnflag AS kind, year(l_shipdate) + 14 AS year, CASE WHEN month(l_shipdate) <= 6 THEN month(l_shipdate) ELSE 0 END AS month, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
    images AS (SELECT kind, year, month, max(seq) AS seq FROM entries GROUP BY ALL)"""


def images(spark, d) -> DataFrame:
    month = F.month("l_shipdate")
    seq = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long")
    rows = A.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("kind"), (F.year("l_shipdate") + 14).alias("year"), F.when(month <= 6, month).otherwise(0).alias("month"), F.concat(F.lit("i"), seq).alias("path"), seq.alias("_seq"), seq.alias("size_bytes"))
    return catalogue.register_images(rows)


@query(f"""WITH {ENTRIES} SELECT kind, year, month, 'i' || seq AS path, 'annual' AS step FROM images WHERE kind = 'A' AND month = 0
    UNION ALL SELECT kind, year, month, 'i' || seq, 'monthly' FROM images WHERE kind = 'R' AND month > 0
    UNION ALL SELECT kind, year, month, 'i' || seq, 'one' FROM images WHERE kind = 'N' AND year = 2010 AND month = 3""")
def image_registry(spark, d):
    own = images(spark, d)
    of = lambda df, step: df.select("kind", "year", "month", "path", F.lit(step).alias("step"))
    one = catalogue.image_path(own, "N", 2010, 3).select(F.lit("N").alias("kind"), F.lit(2010).alias("year"), F.lit(3).alias("month"), "path")
    return of(catalogue.image_registry(own, "A"), "annual").unionByName(of(catalogue.image_registry(own, "R", "monthly"), "monthly")).unionByName(of(one, "one"))


@query(f"WITH {ENTRIES} SELECT kind, count(*) FILTER (month = 0) AS annual, count(*) FILTER (month > 0) AS monthly FROM images GROUP BY ALL")
def image_counts(spark, d):
    return catalogue.image_counts(images(spark, d))


@query(f"WITH {ENTRIES} SELECT kind, year, month, seq AS size_bytes FROM images")
def originals(spark, d):
    return catalogue.originals(images(spark, d)).select("kind", "year", "month", "size_bytes")


@query(f"{S.ANNUAL_AND_ECONOMY} SELECT province_code, year, sol, 'annual' AS name FROM ac UNION ALL SELECT province_code, year, round(grdp, 2), 'economy' FROM econ")
def written_tables(spark, d):
    """Two tables through the writer, one as Parquet and one as CSV, and back."""
    folder = shared_path(spark, "tables")
    catalogue.write_tables({"annual": A.annual(spark, d)}, folder, ["province_code", "year"])
    catalogue.write_tables({"economy": A.economy(spark, d).withColumn("grdp", F.col("grdp").cast("decimal(20,2)"))}, folder, ["province_code", "year"], fmt="csv")
    annual = spark.read.parquet(f"{folder}/annual").select("province_code", "year", "sol", F.lit("annual").alias("name"))
    money = spark.read.option("header", True).csv(f"{folder}/economy")
    return annual.unionByName(money.select("province_code", F.col("year").cast("int").alias("year"), F.round(F.col("grdp").cast("double"), 2).alias("sol"), F.lit("economy").alias("name")))


#: What a first and a second delivery have of the shipments' months: the second repeats some keys with other values, some with the same, and brings new ones.
DELIVERIES = f"""{S.PIXELS_ALL}, months AS (SELECT province_code, year, CAST(month AS INT) AS month, count(*) AS n, sum(CAST(radiation * 8 AS BIGINT)) AS light FROM (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS province_code,
        year(l_shipdate) + 14 AS year, month(l_shipdate) AS month, (l_quantity - 4) / 8.0 AS radiation FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) GROUP BY ALL),
    first AS (SELECT *, year % 2 = 0 OR month > 6 AS sent FROM months), old AS (SELECT province_code, year, month, light FROM first WHERE sent),
    new AS (SELECT province_code, year, month, CASE WHEN n % 3 = 0 THEN light ELSE light + 1000 END AS light FROM months WHERE year >= 2011 AND n % 2 = 0)"""


def deliveries(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = shipments(spark, d).groupBy(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("province_code"), (F.year("l_shipdate") + 14).alias("year"), F.month("l_shipdate").alias("month"))
    rows = rows.agg(F.count("*").alias("n"), F.sum(((F.col("l_quantity") - 4) / 8.0 * 8).cast("long")).alias("light"))
    old = rows.filter("year % 2 = 0 OR month > 6").select("province_code", "year", "month", "light")
    new = rows.filter("year >= 2011 AND n % 2 = 0").select("province_code", "year", "month", F.when(F.col("n") % 3 == 0, F.col("light")).otherwise(F.col("light") + 1000).alias("light"))
    return old, new


def stored_twice(spark, d) -> tuple[str, DataFrame]:
    """A store that both deliveries went into, the second one twice, each row with an outdated one before it; its path and the report of the second."""
    old, new = deliveries(spark, d)
    path, keys = shared_path(spark, "store"), ["province_code", "year", "month"]
    store.upsert(old, path, keys, ["year"])
    outdated = new.withColumns({"light": F.col("light") - 1, "seq": F.lit(0)}).unionByName(new.withColumn("seq", F.lit(1)))
    report = store.upsert(outdated, path, keys, ["year"], "seq")
    store.upsert(outdated, path, keys, ["year"], "seq")
    return path, report


@query(f"{DELIVERIES} SELECT province_code, year, month, coalesce(new.light, old.light) AS light FROM old FULL JOIN new USING (province_code, year, month)")
def store_upsert(spark, d):
    """A stored table after an upsert that was run twice."""
    path, _ = stored_twice(spark, d)
    return spark.read.parquet(path).select("province_code", F.col("year").cast("int").alias("year"), "month", "light")


@query(f"""{DELIVERIES} SELECT year, CASE WHEN old.light IS NULL THEN 'inserted' WHEN old.light = new.light THEN 'unchanged' ELSE 'replaced' END AS action, count(*) AS keys
    FROM new LEFT JOIN old USING (province_code, year, month) GROUP BY ALL""")
def store_report(spark, d):
    """How many keys of the second delivery were new, replaced or the same."""
    _, report = stored_twice(spark, d)
    return report.groupBy(F.col("year").cast("int").alias("year"), "action").agg(F.count("*").alias("keys"))


@query(f"{DELIVERIES} SELECT 'light' AS part, year, count(*) AS rows, sum(light + 5) AS total FROM new GROUP BY year UNION ALL SELECT 'months', year, count(*), sum(month) FROM new GROUP BY year")
def published_set(spark, d):
    """A set of two tables, published three times; the third is computed from the one that it replaces."""
    old, new = deliveries(spark, d)
    folder, months = shared_path(spark, "set"), lambda df: df.select("province_code", "year", "month")
    store.publish({"light": old, "months": months(old)}, folder)
    store.publish({"light": new, "months": months(new)}, folder, overwrite=True)
    second = store.in_use(spark, folder)
    store.publish({"light": second["light"].withColumn("light", F.col("light") + 5), "months": second["months"]}, folder, overwrite=True)
    now = store.in_use(spark, folder)
    light = now["light"].groupBy("year").agg(F.count("*").alias("rows"), F.sum("light").alias("total"))
    count = now["months"].groupBy("year").agg(F.count("*").alias("rows"), F.sum("month").alias("total"))
    return light.withColumn("part", F.lit("light")).unionByName(count.withColumn("part", F.lit("months")))


def day_rows(spark, d) -> DataFrame:
    """The day table with all of its columns."""
    own = A.day(spark, d)
    return own.select(*(F.col(f.name) if f.name in own.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DAY_ANNUAL))
