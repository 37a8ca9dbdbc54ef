"""The registered queries over the given tables and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfield.functions.columns import pct
from lumenfield.operators import catalogue, economy, export, models, panel, quality, raster, series, shaping, tables, timefn, zonal
from lumenfield.plans import details, inputs, light, places
from lumenfield.plans import sql as S
from lumenfield.plans.base import ORACLE_SQL, QUERIES, query
from lumenfield.sources import adapter as A
from lumenfield.sources import ingest
from lumenfield.sources.shared import shared_path, stash

__all__ = ["ORACLE_SQL", "QUERIES", "details", "light", "places"]

@query(f"{S.STATS} SELECT {S.ZONAL_SQL} FROM s")
def zonal_annual(spark, d):
    return A.stats(spark, d).select(*S.names(S.ZONAL_COLUMNS))


@query(f"{S.STATS_MONTHLY} SELECT {S.ZONAL_SQL} FROM s")
def zonal_monthly(spark, d):
    return A.stats(spark, d, True).select(*S.names(S.ZONAL_COLUMNS))


@query(f"{S.ANNUAL} SELECT {S.ANNUAL_COLUMNS} FROM ac")
def annual_series(spark, d):
    return A.annual(spark, d, True).select(*S.names(S.ANNUAL_COLUMNS))


@query(f"{S.MONTHLY} SELECT {S.MONTHLY_COLUMNS} FROM m")
def monthly_series(spark, d):
    return A.monthly(spark, d).select(*S.names(S.MONTHLY_COLUMNS))


@query(f"""{S.STATS} SELECT 2014 AS year, 0 AS month, sum(sol) AS sol, sum(area_km2) AS area_km2, sum(sol) / sum(area_km2) AS sol_density,
    count(*) AS provinces, string_agg(DISTINCT source, ',' ORDER BY source) AS source
    FROM s WHERE year = 2014 AND source = 'VIIRS' AND sol IS NOT NULL HAVING count(*) > 0""")
def national_summary(spark, d):
    return catalogue.national_summary(zonal.annual_rows(A.stats(spark, d)), 2014)


@query(f"""{S.STATS_MONTHLY} SELECT 2014 AS year, 6 AS month, sum(sol) AS sol, sum(area_km2) AS area_km2, sum(sol) / sum(area_km2) AS sol_density,
    count(*) AS provinces, string_agg(DISTINCT source, ',' ORDER BY source) AS source FROM s WHERE year = 2014 AND month = 6 AND sol IS NOT NULL HAVING count(*) > 0""")
def national_summary_month(spark, d):
    return catalogue.national_summary(A.stats(spark, d, True), 2014, 6)


@query(f"{S.STATS} SELECT * FROM ({S.OVERLAP})")
def overlap_pairs(spark, d):
    return models.overlap_pairs(A.stats(spark, d))


@query(f"{S.STATS}, o AS ({S.OVERLAP}) SELECT {S.fit('sol_dmsp', 'sol_viirs', 6)} FROM o WHERE sol_dmsp > 0 AND sol_viirs > 0 HAVING count(*) >= 5")
def calibration_model(spark, d):
    model = models.fit_log_model(models.overlap_pairs(A.stats(spark, d)), "sol_dmsp", "sol_viirs", 5)
    return S.rounded(model, 6, "alpha", "beta", "r2")


@query(f"{S.JOINED} SELECT {S.fit('sol_cal', 'gdp', 6)} FROM j WHERE year >= 2014 AND sol_cal > 0 AND gdp > 0 HAVING count(*) >= 10")
def gdp_model(spark, d):
    return S.rounded(models.gdp_model(joined(spark, d)), 6, "alpha", "beta", "r2")


def joined(spark, d):
    return economy.attach_economy(A.annual(spark, d, True), A.economy_input(spark, d))


def with_indicators(spark, d):
    # the model and the rows that it is applied to
    rows = stash(joined(spark, d), "joined")
    rows = models.light_gdp_elasticity(economy.sol_per_capita(rows))
    return models.predicted_gdp(rows, models.gdp_model(rows))


@query(f"""{S.JOINED}, g AS (SELECT regr_intercept(ln(gdp), ln(sol_cal)) AS a, regr_slope(ln(gdp), ln(sol_cal)) AS b FROM j WHERE year >= 2014 AND sol_cal > 0 AND gdp > 0 HAVING count(*) >= 10),
    w AS (SELECT *, {S.PREVIOUS.format(c='sol_cal')} AS p_light, {S.PREVIOUS.format(c='gdp')} AS p_gdp FROM j)
    SELECT province_code, year, population, round(gdp, 2) AS gdp, sol, round(sol_cal, 4) AS sol_cal,
        CASE WHEN population > 0 THEN round(sol_cal / population, 6) END AS sol_per_capita,
        CASE WHEN year <> 2010 AND p_light > 0 AND p_gdp > 0 AND gdp <> p_gdp THEN round((100 * (sol_cal / p_light - 1)) / (100 * (gdp / p_gdp - 1)), 6) + 0 END AS light_gdp_elasticity,
        CASE WHEN sol_cal > 0 THEN round(exp((SELECT a FROM g) + (SELECT b FROM g) * ln(sol_cal)), 4) END AS predicted_gdp
    FROM w""")
def light_economy(spark, d):
    out = with_indicators(spark, d).withColumns({"gdp": F.round("gdp", 2), "sol_cal": F.round("sol_cal", 4), "predicted_gdp": F.round("predicted_gdp", 4)})
    return out.select("province_code", "year", "population", "gdp", "sol", "sol_cal", "sol_per_capita", "light_gdp_elasticity", "predicted_gdp")


@query(f"""{S.JOINED}, g AS (SELECT regr_intercept(ln(gdp), ln(sol_cal)) AS a, regr_slope(ln(gdp), ln(sol_cal)) AS b FROM j WHERE year >= 2014 AND sol_cal > 0 AND gdp > 0 HAVING count(*) >= 10),
    p AS (SELECT *, CASE WHEN sol_cal > 0 THEN exp((SELECT a FROM g) + (SELECT b FROM g) * ln(sol_cal)) END AS predicted, sum(sol) OVER (PARTITION BY year, source) AS country FROM j),
    n AS (SELECT *, CASE WHEN country > 0 THEN round(100 * sol / country, 6) END AS share FROM p)
    SELECT province_code, year, source, round(100 * (gdp - predicted) / predicted, 4) AS gdp_gap_pct, round(1e9 * sol_cal / gdp, 6) AS light_per_gdp_e9, CASE WHEN lit_area_km2 > 0 THEN round(lit_sol / lit_area_km2, 4) END AS lit_intensity, share AS national_share_pct,
        round(share - max(share) OVER (PARTITION BY province_code, source ORDER BY year RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 6) AS share_shift FROM n""")
def economy_indicators(spark, d):
    """Light against GDP and against the country, for every province and year."""
    out = economy.derived_indicators(with_indicators(spark, d))
    return out.select("province_code", "year", "source", "gdp_gap_pct", F.round(F.col("light_per_gdp") * 1e9, 6).alias("light_per_gdp_e9"), "lit_intensity", "national_share_pct", "share_shift")


@query(f"""{S.JOINED} SELECT 'G.' || province_code AS gid_1, province_name AS name_1, year, 0 AS month, population, round(gdp, 2) AS gdp, sol_raw, sol, lit_area_km2, lit_area_pct,
    round(sol_cal, 4) AS sol_cal, round(sol_cal / area_km2, 6) AS sol_density, {S.pct('sol_cal', S.PREVIOUS.format(c='sol_cal'))} AS sol_change_pct, 'sol_cal' AS light_basis,
    CASE WHEN gdp IS NULL THEN '' ELSE 'so_sanh' END AS grdp_price_basis, CASE WHEN gdp IS NULL THEN '' ELSE 'orders' END AS economy_source, 'DMSP_TO_VIIRS_POWER_OVERLAP2013_v1' AS calibration, obs_status FROM j""")
def night_economy(spark, d):
    out = tables.night_economy(with_indicators(spark, d), A.provinces(spark, d), True)
    return out.withColumn("gdp", F.round("gdp", 2)).drop("sol_per_capita", "light_gdp_elasticity", "predicted_gdp")


@query(f"""{S.MONTHLY} SELECT 'G.' || province_code AS gid_1, province_name AS name_1, year, month, CAST(NULL AS VARCHAR) AS avg_rad, CAST(NULL AS VARCHAR) AS cf_cvg, area_km2, valid_pixels AS total_pixels,
    cloud_free_obs, sol_raw AS tnl, rad_mean AS mean_rad, rad_std AS std_rad, rad_min AS min_rad, rad_max AS max_rad, spatial_cv, lit_pixels, lit_sol AS lit_pop_proxy,
    lit_pixel_pct AS electrification_ratio_pct, tnl_ma3, tnl_mom_growth_pct FROM m""")
def night_data(spark, d):
    return tables.night_data(A.monthly(spark, d), A.provinces(spark, d))


@query(f"""{S.BOTH} SELECT province_code, year, 0 AS month, source, sol, sol_density, obs_status FROM ac WHERE source = 'DMSP'
    UNION ALL SELECT province_code, year, month, source, sol, sol_density, obs_status FROM m WHERE year >= 2014""")
def ntl_panel(spark, d):
    return tables.ntl_panel(A.annual(spark, d, both=True), A.monthly(spark, d, both=True)).select("province_code", "year", "month", "source", "sol", "sol_density", "obs_status")


@query(f"""{S.ANNUAL}, l AS (SELECT {', '.join(tables.LIGHT_FIELDS)} FROM ac WHERE province_code = '05' AND year BETWEEN 2007 AND 2014)
    SELECT * REPLACE (round(sol_cal, 4) AS sol_cal) FROM l""")
def province_light(spark, d):
    return own_series(spark, d)["light"].withColumn("sol_cal", F.round("sol_cal", 4))


def own_series(spark, d):
    return tables.province_series(A.provinces(spark, d), A.annual(spark, d, True), inputs.day_rows(spark, d), A.economy(spark, d), "5", 2007, 2014)


@query(f"{S.PIXELS}, day AS ({S.DAY_ROWS}) SELECT year, 'S2' AS source, ndvi AS NDVI_mean, 'OK' AS status FROM day WHERE province_code = '05' AND year BETWEEN 2007 AND 2014")
def province_day(spark, d):
    return own_series(spark, d)["day"].select("year", "source", "NDVI_mean", "status")


@query(f"WITH {S.PROV}, {S.ECONOMY} SELECT year, population, round(grdp, 2) AS gdp, round(grdp / population, 6) AS gdp_per_capita, 'orders' AS source FROM econ WHERE province_code = '05' AND year BETWEEN 2007 AND 2014")
def province_economy(spark, d):
    return own_series(spark, d)["economy"].withColumns({"gdp": F.round("gdp", 2), "gdp_per_capita": F.round("gdp_per_capita", 6)})


VIEW = f"""{S.ANNUAL_AND_ECONOMY}, v AS (SELECT e.province_code, e.year, e.population, e.grdp, p.province_name, p.number, ac.sol FROM econ e JOIN prov p USING (province_code)
    LEFT JOIN ac ON ac.province_code = e.province_code AND ac.year = e.year WHERE e.year BETWEEN 2009 AND 2015)"""


def view_rows(spark, d):
    return economy.night_economy_view(A.economy(spark, d), A.provinces(spark, d), A.annual(spark, d), 2009, 2015)


@query(f"""{VIEW} SELECT province_code, year, population, round(grdp, 2) AS grdp, province_name, number, sol,
    round(CASE WHEN sol <> 0 AND population <> 0 THEN sol / population END, 9) AS sol_per_capita FROM v""")
def night_economy_view(spark, d):
    return view_rows(spark, d).select("province_code", "year", "population", F.round("grdp", 2).alias("grdp"), "province_name", "number", "sol", F.round("sol_per_capita", 9).alias("sol_per_capita"))


@query(f"""{VIEW}, b AS (SELECT province_code, round(regr_slope(ln(grdp), ln(sol)), 6) AS beta FROM v WHERE sol > 0 AND grdp > 0 GROUP BY province_code HAVING count(*) >= 5 AND regr_sxx(ln(grdp), ln(sol)) > 0)
    SELECT v.province_code, v.year, b.beta AS beta_tinh FROM v LEFT JOIN b USING (province_code)""")
def province_slopes(spark, d):
    """The slope of each province beside its rows, from five pairs on."""
    rows = economy.night_economy_view(A.economy(spark, d), A.provinces(spark, d), A.annual(spark, d), 2009, 2015, minimum=5)
    return rows.select("province_code", "year", "beta_tinh")


@query(f"""{VIEW}, f AS (SELECT count(*) AS n, regr_r2(ln(grdp), ln(sol)) AS r2 FROM v WHERE sol > 0 AND grdp > 0)
    SELECT n, CASE WHEN n < 10 THEN 'under 10 usable observations' WHEN r2 < 0.5 THEN 'R2 under 0.5: the relation is weak' ELSE '' END AS warnings FROM f""")
def elasticity_warnings(spark, d):
    return models.elasticity_pooled(view_rows(spark, d)).select("n", F.array_join("warnings", "; ").alias("warnings"))


@query(f"{VIEW} SELECT {S.fit('sol', 'grdp', 6)} FROM v WHERE sol > 0 AND grdp > 0 HAVING count(*) >= 10")
def elasticity_pooled(spark, d):
    return models.elasticity_pooled(view_rows(spark, d)).select("alpha", "beta", "r2", "n")


@query(f"{VIEW} SELECT province_code, {S.fit('sol', 'grdp', 6, 'beta r2 n')} FROM v WHERE sol > 0 AND grdp > 0 GROUP BY province_code HAVING count(*) >= 5 AND regr_sxx(ln(grdp), ln(sol)) > 0")
def elasticity_by_province(spark, d):
    return models.elasticity_by_province(view_rows(spark, d), minimum=5)


@query(f"""{VIEW}, l AS (SELECT min(ln(sol)) AS x_low, max(ln(sol)) AS x_high, regr_slope(ln(grdp), ln(sol)) AS b, regr_intercept(ln(grdp), ln(sol)) AS a FROM v WHERE sol > 0 AND grdp > 0)
    SELECT round(x_low, 6) AS x_low, round(x_high, 6) AS x_high, round(a + b * x_low, 6) AS y_low, round(a + b * x_high, 6) AS y_high, round(b * 10, 6) AS grdp_pct FROM l""")
def fitted_line(spark, d):
    out = shaping.fit_line(view_rows(spark, d)).withColumn("grdp_pct", shaping.interpretation(F.col("beta")))
    return S.rounded(out.select("x_low", "x_high", "y_low", "y_high", "grdp_pct"), 6, "x_low", "x_high", "y_low", "y_high", "grdp_pct")


PANEL_CODES, PANEL_PERIODS = ["sol", "rad_cv", "sol_ma3", "gdp"], ["2014-02", "2012", "2014", "2014-01", "2013"]
PANEL = f"""{S.EVERYTHING}, t(year, month, period, period_order) AS (VALUES (2012, 0, '2012', 0), (2013, 0, '2013', 1), (2014, 0, '2014', 2), (2014, 1, '2014-01', 3), (2014, 2, '2014-02', 4)),
    i(indicator, indicator_order) AS (VALUES ('sol', 0), ('rad_cv', 1), ('sol_ma3', 2), ('gdp', 3)),
    long AS (SELECT province_code, year, 0 AS month, 'sol' AS indicator, sol AS value, source, obs_status AS flag FROM ac
        UNION ALL SELECT province_code, year, 0, 'rad_cv', rad_cv, source, obs_status FROM ac
        UNION ALL SELECT province_code, year, month, 'sol', sol, source, obs_status FROM m
        UNION ALL SELECT province_code, year, month, 'rad_cv', rad_cv, source, obs_status FROM m
        UNION ALL SELECT province_code, year, month, 'sol_ma3', sol_ma3, source, obs_status FROM m
        UNION ALL SELECT province_code, year, 0, 'gdp', grdp, 'orders', NULL FROM econ),
    cells AS (SELECT l.*, t.period FROM long l JOIN t USING (year, month)),
    src AS (SELECT province_code, string_agg(DISTINCT source, '/' ORDER BY source) AS source FROM cells GROUP BY province_code),
    p AS (SELECT prov.province_code, province_name, number, i.indicator, indicator_order, t.period, period_order, c.value, nullif(c.flag, 'A') AS flag, src.source
        FROM prov CROSS JOIN i CROSS JOIN t LEFT JOIN cells c ON c.province_code = prov.province_code AND c.indicator = i.indicator AND c.period = t.period
        LEFT JOIN src ON src.province_code = prov.province_code)"""


def panel_rows(spark, d):
    return panel.panel_long(A.tables(spark, d, "ntl_annual", "ntl_monthly", "economy"), A.provinces(spark, d), PANEL_CODES, PANEL_PERIODS)


@query(f"{PANEL} SELECT province_code, province_name, number, indicator, indicator_order, period, period_order, round(p.value, 4) AS value, flag, source FROM p")
def panel_long(spark, d):
    return panel_rows(spark, d).drop("unit").withColumn("value", F.round("value", 4))


@query(f"""{PANEL} SELECT province_code, indicator, source, {', '.join(f"round(max(p.value) FILTER (period = '{x}'), 4) AS p{x.replace('-', '_')}" for x in sorted(PANEL_PERIODS))}
    FROM p GROUP BY province_code, indicator, source""")
def panel_wide(spark, d):
    periods = sorted(PANEL_PERIODS)
    return panel.panel_wide(panel_rows(spark, d), periods).select("province_code", "indicator", "source", *(F.round(F.col(f"`{x}`"), 4).alias(f"p{x.replace('-', '_')}") for x in periods))


@query(f"{PANEL} SELECT province_code, province_name, period, indicator, round(p.value, 4) AS value, source FROM p WHERE p.value IS NOT NULL")
def panel_cells(spark, d):
    return panel.panel_cells(panel_rows(spark, d)).drop("unit").withColumn("value", F.round("value", 4))


@query(f"""{PANEL} SELECT province_code, indicator, period, round(p.value, 4) AS value FROM p WHERE province_code IN ('01', '02', '17') AND indicator IN ('sol', 'gdp') AND period IN ('2012', '2014-01')""")
def panel_of_provinces(spark, d):
    """Only some provinces, by codes with and without a zero, and indicators with blanks around them."""
    tables_ = A.tables(spark, d, "ntl_annual", "ntl_monthly", "economy")
    rows = panel.panel_long(tables_, A.provinces(spark, d), [" sol ", "gdp", ""], ["2014-01", "2012"], ["1", "02", " 17 "])
    return rows.select("province_code", "indicator", "period", F.round("value", 4).alias("value"))


@query(f"{PANEL} SELECT count(DISTINCT province_code) FILTER (p.value IS NOT NULL) AS provinces_with_data, bool_or(length(period) > 4) AS has_months FROM p")
def panel_meta(spark, d):
    return panel.panel_meta(panel_rows(spark, d))


@query(f"""{S.ANNUAL}, x AS (SELECT province_code, 'sol' AS indicator, year, sol AS v FROM ac WHERE year IN (2011, 2012, 2013) AND sol IS NOT NULL
        UNION ALL SELECT province_code, 'sol_cal', year, sol_cal FROM ac WHERE year IN (2011, 2012, 2013) AND sol_cal IS NOT NULL)
    SELECT province_code, indicator, round(sum(v), 4) AS tong, round(avg(v), 4) AS trung_binh,
        CASE WHEN count(*) >= 2 AND arg_min(v, year) > 0 THEN round(100 * (arg_max(v, year) / arg_min(v, year) - 1), 4) END AS thay_doi,
        CASE WHEN count(*) >= 2 AND arg_min(v, year) > 0 THEN round(100 * (pow(arg_max(v, year) / arg_min(v, year), 1.0 / (max(year) - min(year))) - 1), 4) END AS cagr
    FROM x GROUP BY province_code, indicator""")
def time_functions(spark, d):
    rows = panel.panel_long(A.tables(spark, d, "ntl_annual"), A.provinces(spark, d), ["sol", "sol_cal"], ["2011", "2012", "2013"]).filter("value IS NOT NULL")
    return timefn.time_functions(rows).drop("refused")


@query(f"""{S.ANNUAL} SELECT province_code, 'sol' AS indicator, round(sum(sol), 4) AS tong, CAST(NULL AS DOUBLE) AS cagr, 2 AS n_refused FROM ac GROUP BY province_code""")
def time_functions_refused(spark, d):
    rows = panel.panel_long(A.tables(spark, d, "ntl_annual"), A.provinces(spark, d), ["sol"], None, None, 2009, 2015)
    out = timefn.time_functions(rows, ["tong", "cagr"]).filter("tong IS NOT NULL")
    return out.select("province_code", "indicator", "tong", "cagr", F.size("refused").alias("n_refused"))


@query(f"""{S.BOTH} SELECT p.province_code, p.number, p.province_name, count(ac.year) AS light_rows,
    (SELECT count(*) FROM ({S.DAY}) x WHERE x.province_code = p.province_code) AS day_rows FROM prov p LEFT JOIN ac USING (province_code) GROUP BY ALL""")
def provinces_with_counts(spark, d):
    out = catalogue.provinces_with_counts(A.provinces(spark, d), A.annual(spark, d), A.day(spark, d))
    return out.select("province_code", "number", "province_name", "light_rows", "day_rows")


@query(f"""{S.BOTH} SELECT p.province_code, p.province_name, count(ac.year) AS light_rows FROM prov p LEFT JOIN ac USING (province_code) WHERE p.province_code = '07' GROUP BY ALL""")
def province_row(spark, d):
    out = catalogue.provinces_with_counts(A.provinces(spark, d), A.annual(spark, d), A.day(spark, d))
    return catalogue.province(out, " 7 ").select("province_code", "province_name", "light_rows")


@query(f"""{S.ANNUAL_AND_ECONOMY} SELECT 'light' AS kind, year, count(*) AS rows FROM ac GROUP BY year UNION ALL SELECT 'economy', year, count(*) FROM econ GROUP BY year
    UNION ALL SELECT 'day', year, count(*) FROM ({S.DAY}) GROUP BY year""")
def coverage(spark, d):
    return catalogue.coverage(A.annual(spark, d), A.day(spark, d), A.economy(spark, d))


@query(S.coverage_sql())
def indicator_coverage(spark, d):
    return catalogue.indicator_coverage(A.tables(spark, d)).select("indicator", "provinces", "first_year", "last_year")


@query(f"""{S.ANNUAL}, c AS (SELECT province_code, rad_cv AS v FROM ac WHERE year = 2014 AND rad_cv IS NOT NULL), q AS (SELECT min(v) AS lo, max(v) AS hi, list_sort(list(v))[count(*) // 2 + 1] AS med FROM c)
    SELECT province_code, v AS value, lo AS least, hi AS greatest, med AS upper_median FROM c CROSS JOIN q""")
def choropleth(spark, d):
    return catalogue.choropleth({"ntl_annual": A.annual(spark, d)}, "rad_cv", 2014)


@query(f"""{S.MONTHLY}, c AS (SELECT province_code, arg_max(sol_ma3, month) AS v FROM m WHERE year = 2014 AND sol_ma3 IS NOT NULL GROUP BY province_code), q AS (SELECT min(v) AS lo, max(v) AS hi, list_sort(list(v))[count(*) // 2 + 1] AS med FROM c)
    SELECT province_code, v AS value, lo AS least, hi AS greatest, med AS upper_median FROM c CROSS JOIN q""")
def choropleth_monthly(spark, d):
    return catalogue.choropleth({"ntl_monthly": A.monthly(spark, d)}, "sol_ma3", 2014)


@query(f"""{S.ANNUAL_AND_ECONOMY}, day AS ({S.DAY}), codes AS (SELECT DISTINCT province_code FROM ac UNION SELECT province_code FROM day UNION SELECT province_code FROM econ),
    l AS (SELECT province_code, min(year) <= 2009 AND max(year) >= 2010 AS crosses, count(DISTINCT source) > 1 AS mixed FROM ac GROUP BY ALL), t AS (SELECT province_code, bool_or(year BETWEEN 2015 AND 2018) AS toa FROM day GROUP BY ALL)
    SELECT province_code, concat_ws(' ', CASE WHEN toa THEN '{quality.TOA}' END, CASE WHEN crosses THEN '{quality.BREAK_2010}' END, CASE WHEN mixed THEN '{quality.USE_CALIBRATED}' END) AS warnings, false AS simulated
    FROM codes LEFT JOIN l USING (province_code) LEFT JOIN t USING (province_code)""")
def series_warnings(spark, d):
    out = quality.series_warnings(A.annual(spark, d, True), A.day(spark, d), A.economy(spark, d))
    return out.select("province_code", F.array_join("warnings", " ").alias("warnings"), "simulated")


#: Economy rows of which some are labelled as simulated.
MARKED = "CASE WHEN year % 3 = 0 THEN 'gia_lap b=' || year % 2 ELSE 'orders' END"


def marked_economy(spark, d):
    marked = F.concat(F.lit("gia_lap b="), F.col("year") % 2)
    return A.economy(spark, d).withColumn("source", F.when(F.col("year") % 3 == 0, marked).otherwise("orders"))


@query(f"WITH {S.PROV}, {S.ECONOMY} SELECT coalesce(string_agg(DISTINCT {MARKED}, ';' ORDER BY {MARKED}) FILTER (year % 3 = 0), '') AS labels FROM econ")
def simulated_labels(spark, d):
    return quality.simulated_labels(marked_economy(spark, d)).select(F.array_join("simulated_labels", ";").alias("labels"))


@query(f"""WITH {S.PROV}, {S.ECONOMY} SELECT CASE WHEN bool_or(year % 3 = 0) THEN '{quality.SIMULATED_WARNING} ' ELSE '' END || CASE WHEN count(DISTINCT year % 2) > 1 THEN 'It is not known whether GRDP is in constant or current prices.'
    WHEN max(year % 2) = 1 THEN 'GRDP is in current prices, so the elasticity holds inflation too.' ELSE '' END AS warnings FROM econ""")
def economy_warnings(spark, d):
    return quality.economy_warnings(marked_economy(spark, d)).select(F.array_join("warnings", " ").alias("warnings"))


@query(f"""{S.ANNUAL}, y AS (SELECT min(year) AS lo, max(year) AS hi FROM ac), w(position, warning, fires) AS (SELECT 1, '{quality.BREAK_2010}', lo <= 2009 AND hi >= 2010 FROM y UNION ALL SELECT 2, '{quality.BREAK_2014}', lo <= 2013 AND hi >= 2013 FROM y
        UNION ALL SELECT 3, '{quality.TOA}', (SELECT bool_or(year BETWEEN 2015 AND 2018) FROM ac) UNION ALL SELECT 4, '{quality.PROVIDED}', true)
    SELECT warning FROM w WHERE fires""")
def panel_warnings(spark, d):
    """What a panel over all years of the annual table (at most some dozens) has to say."""
    years = [r["year"] for r in A.annual(spark, d).select("year").distinct().collect()]
    return spark.createDataFrame([(w,) for w in quality.panel_warnings(["sol", "NDVI_mean", "gdp"], years)] if years else [], "warning string")


@query(f"WITH {S.PROV}, {S.ECONOMY} SELECT string_agg(DISTINCT CASE WHEN year % 2 = 0 THEN 'so_sanh' ELSE 'hien_hanh' END, ',' ORDER BY CASE WHEN year % 2 = 0 THEN 'so_sanh' ELSE 'hien_hanh' END) AS bases, CAST(NULL AS BOOLEAN) AS constant_prices FROM econ")
def price_basis(spark, d):
    return quality.price_basis_state(A.economy(spark, d)).withColumn("bases", F.array_join("bases", ","))


@query(f"""{S.ANNUAL_AND_ECONOMY} SELECT province_code, province_code NOT IN (SELECT province_code FROM ac) AS missing_light, province_code NOT IN (SELECT province_code FROM ({S.DAY})) AS missing_day,
    province_code NOT IN (SELECT province_code FROM econ) AS missing_economy FROM prov""")
def missing_parts(spark, d):
    return quality.missing_parts(A.provinces(spark, d), A.annual(spark, d), A.day(spark, d), A.economy(spark, d))


@query("""WITH v AS (SELECT user_id, day(ts) AS day, round(sum(CAST(round(value * 8) AS BIGINT)) / 8.0, 4) AS value FROM events GROUP BY ALL)
    SELECT user_id, day, v.value, round(avg(v.value) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS calendar_ma3,
        round(avg(v.value) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS row_ma3,
        CASE WHEN lag(v.value) OVER w > 0 THEN round(100 * (v.value / lag(v.value) OVER w - 1), 4) END AS row_change_pct
    FROM v WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def sparse_series(spark, d):
    """Calendar against row frames on series with gaps."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("day")
    out = series.row_changes(A.daily_series(spark, d), "value", "row", "user_id", ("day",))
    return out.select("user_id", "day", "value", F.round(F.avg("value").over(w.rangeBetween(-2, 0)), 4).alias("calendar_ma3"), "row_ma3", F.col("row_mom_growth_pct").alias("row_change_pct"))


@query(f"""{S.PIXELS}, v AS (SELECT * FROM pixel WHERE mask), f AS (SELECT source, year, "row", col, min(province_code) AS tile FROM v GROUP BY ALL)
    SELECT f.source, f.year, f."row", f.col, f.tile, count(*) AS n, max(radiation) AS brightest FROM f JOIN v ON v.source = f.source AND v.year = f.year AND v."row" = f."row" AND v.col = f.col AND v.province_code = f.tile GROUP BY ALL""")
def mosaic(spark, d):
    """A mosaic of each annual image set. Several pixels of a tile can share a cell here, so the brightest of the winning tile is shown."""
    from lumenfield.functions.columns import is_valid

    rows = A.pixels(spark, d).groupBy("source", "year", "province_code", "row", "col").agg(F.max(F.when(is_valid(), F.col("radiation"))).alias("bright"), F.count_if(is_valid()).alias("n"))
    # the number of pixels goes with the tile, so the tiles need not be joined again
    tile = rows.select("source", "year", "row", "col", F.struct("province_code", "n").alias("tile"), F.col("bright").alias("radiation"), F.lit(True).alias("mask"))
    won = raster.mosaic(tile, "tile", ["source", "year"])
    return won.select("source", "year", "row", "col", F.col("tile.province_code").alias("tile"), F.col("tile.n").alias("n"), F.col("radiation").alias("brightest"))


@query(f"""{S.PIXELS} SELECT source, year, k AS factor, "row" // k AS "row", col // k AS col, round(avg(radiation), 6) AS radiation, count(*) AS n
    FROM pixel CROSS JOIN (VALUES (2), (4), (8), (16), (32)) f(k) WHERE mask GROUP BY ALL""")
def overview(spark, d):
    """The overviews of every annual image set."""
    return raster.overview(A.pixels(spark, d), keys=["source", "year"])


@query(f"""{S.PIXELS} SELECT province_code, round(min(lon) - 0.002, 6) AS west, round(min(lat) - 0.002, 6) AS south, round(max(lon) + 0.002, 6) AS east, round(max(lat) + 0.002, 6) AS north
    FROM (SELECT *, 102 + col * 0.004 AS lon FROM pixel) GROUP BY province_code""")
def image_extent(spark, d):
    return raster.image_extent(A.pixels(spark, d).withColumn("lon", 102 + F.col("col") * F.lit(0.004)), ["province_code"], 0.004)


@query(f"""{S.PIXELS}, b AS (SELECT "row" // 8 AS "row", col // 8 AS col, year - 2012 AS band, least(greatest(CAST(floor(avg(radiation * 800) * 255 / 3000 + 0.5) AS BIGINT), 0), 255) AS v
        FROM pixel WHERE year IN (2013, 2014, 2015) AND source = 'VIIRS' AND mask GROUP BY ALL)
    SELECT "row", col, max(v) FILTER (band = 3) AS red, max(v) FILTER (band = 2) AS green, max(v) FILTER (band = 1) AS blue FROM b GROUP BY ALL""")
def rgb_quicklook(spark, d):
    rows = A.pixels(spark, d).filter("source = 'VIIRS'").withColumns({"band": F.col("year") - 2012, "radiation": F.col("radiation") * 800})
    return raster.rgb_quicklook(rows, 8)


@query(f"""{S.PIXELS_ALL}, k AS (SELECT province_code, year, source, count(*) AS pixels FROM every GROUP BY ALL)
    SELECT province_code, year, source, CASE WHEN (source = 'VIIRS' AND year < 2013) OR (source = 'DMSP' AND year > 2013) THEN 'source does not fit the period' ELSE 'ok' END AS verdict FROM k""")
def manifest(spark, d):
    """The images that the shipments stand for, as a manifest."""
    line, supplier = A.table(spark, d, "lineitem"), A.table(spark, d, "supplier")
    year = F.year("l_shipdate") + 14
    source = F.when((year <= 2013) & (F.col("l_linenumber") % 2 == 1), "DMSP").otherwise("VIIRS")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").cast("string").alias("province_code"), year.cast("string").alias("year"), source.alias("source")).distinct()
    names = A.provinces(spark, d).select(F.col("number"), "province_name", F.col("area_km2").cast("string").alias("area_km2"))
    rows = rows.join(names, F.col("number") == F.col("province_code").cast("int") + 1).withColumns({"month": F.lit(""), "path": F.concat_ws("_", "source", "province_code", "year")})
    valid, rejects = ingest.validate_manifest(rows)
    columns = ["province_code", F.col("year").cast("int").alias("year"), "source"]
    return valid.select(*columns, F.lit("ok").alias("verdict")).unionByName(rejects.select(*columns, F.col("error").alias("verdict")))


@query("""SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS province_code, year(l_shipdate) AS year, string_agg(DISTINCT l_returnflag, '/' ORDER BY l_returnflag) AS source,
    round(avg(l_quantity), 6) AS sol, CAST(count(*) AS INT) AS months_used FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""")
def rollup_to_year(spark, d):
    from pyspark.sql import types as T

    line, supplier = A.table(spark, d, "lineitem"), A.table(spark, d, "supplier")
    raw = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    raw = raw.select(F.concat(F.lit(" "), F.col("s_nationkey")).alias("province_code"), F.year("l_shipdate").cast("string").alias("nam"), F.col("l_returnflag").alias("source"), F.col("l_quantity").cast("string").alias("sol"))
    schema = T.StructType([T.StructField("province_code", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("source", T.StringType()), T.StructField("sol", T.DoubleType())])
    return ingest.rollup_to_year(raw, schema)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders) SELECT o_custkey, o_orderkey, o_orderstatus FROM r WHERE k = 1""")
def dedupe_last(spark, d):
    return ingest.dedupe_last(A.table(spark, d, "orders"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus")


@query(f"{S.ANNUAL} SELECT province_code, province_name, year, sol, 8 AS kept, (SELECT count(DISTINCT province_code) FROM ac) AS total FROM ac WHERE province_name IN (SELECT DISTINCT province_name FROM ac ORDER BY 1 LIMIT 8) AND year > 2025 - 13")
def limit_series(spark, d):
    rows = A.annual(spark, d).select("province_code", "province_name", "year", "sol")
    return shaping.recent_years(shaping.limit_series(rows), 13)


@query("SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_code, n_name AS province_name FROM nation WHERE n_name ILIKE '%tion_1%'")
def search_province(spark, d):
    return shaping.order_vietnamese(shaping.search_province(A.provinces(spark, d), " tIon_1 ")).select("province_code", "province_name")


@query(f"""{S.ANNUAL} SELECT year, count(*) AS provinces, sum(CASE WHEN obs_status = 'B' THEN 1 ELSE 0 END)::BIGINT AS breaks, sum(CASE WHEN obs_status = 'U' THEN 1 ELSE 0 END)::BIGINT AS unsure,
    count(*) FILTER (note <> '') AS noted FROM ac GROUP BY year""")
def flags_by_year(spark, d):
    a = A.annual(spark, d)
    return a.groupBy("year").agg(F.count("*").alias("provinces"), F.count_if(F.col("obs_status") == "B").alias("breaks"), F.count_if(F.col("obs_status") == "U").alias("unsure"), F.count_if(F.col("note") != "").alias("noted"))


@query(f"""{S.ANNUAL} SELECT province_code, year, CASE WHEN lag(source) OVER w = source AND lag(year) OVER w = year - 1 THEN {S.pct('sol', 'lag(sol) OVER w')} END AS change_pct FROM ac WINDOW w AS (PARTITION BY province_code ORDER BY year)""")
def economy_change(spark, d):
    return series.economy_change(A.annual(spark, d)).select("province_code", "year", "change_pct")


@query(f"""{S.ANNUAL_AND_ECONOMY} SELECT e.province_code, e.year, {S.pct('e.grdp', 'b.grdp')} AS grdp_change_pct FROM econ e LEFT JOIN econ b ON b.province_code = e.province_code AND b.year = e.year - 1""")
def grdp_change(spark, d):
    from lumenfield.functions.columns import at_offset

    return A.economy(spark, d).select("province_code", "year", pct("grdp", at_offset("grdp", ["province_code"], "year", -1)).alias("grdp_change_pct"))


def squares(spark, d, size):
    """A square ring for each nation, on a 64 x 64 grid of unit cells whose upper left corner is at (0, 64)."""
    x, y = F.col("n_nationkey") % 5 * 12 + 0.3, F.floor(F.col("n_nationkey") / 5) * 12 + 0.3
    point = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    ring = F.array(point(x, y), point(x + size, y), point(x + size, y + size), point(x, y + size))
    return A.table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("province_code"), ring.alias("ring"))


def runs(spark, d, size):
    return raster.province_runs(raster.edges(squares(spark, d, size)), 0.0, 64.0, 1.0, 64, 64)


SQUARES = """cells AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, r AS "row", c AS col FROM nation CROSS JOIN range(64) a(r) CROSS JOIN range(64) b(c)
    WHERE c + 0.5 >= n_nationkey % 5 * 12 + 0.3 AND c + 0.5 < n_nationkey % 5 * 12 + 0.3 + {size} AND 64 - (r + 0.5) >= n_nationkey // 5 * 12 + 0.3 AND 64 - (r + 0.5) < n_nationkey // 5 * 12 + 0.3 + {size})"""


@query(f"""{S.PIXELS}, {SQUARES.format(size=10)} SELECT code AS province_code, year, count(*) AS pixels, sum(radiation) FILTER (mask) AS sol_raw
    FROM pixel JOIN cells ON cells."row" = pixel."row" AND cells.col = pixel.col WHERE source = 'VIIRS' GROUP BY ALL""")
def clip_pixels(spark, d):
    """Light of the cells inside each square, whatever province the pixels came with."""
    from lumenfield.functions.columns import is_valid

    rows = raster.clip(A.pixels(spark, d).filter("source = 'VIIRS'").drop("province_code"), runs(spark, d, 10))
    return rows.groupBy("province_code", "year").agg(F.count("*").alias("pixels"), F.sum(F.when(is_valid(), F.col("radiation"))).alias("sol_raw"))


@query(f"""{S.PIXELS}, {SQUARES.format(size=10)}, wanted AS (SELECT DISTINCT year, province_code, CAST(province_code AS INT) AS n FROM pixel WHERE source = 'VIIRS'),
    extent AS (SELECT year, province_code, 53 - n // 5 * 12 + i AS "row", n % 5 * 12 + j AS col FROM wanted CROSS JOIN range(11) a(i) CROSS JOIN range(11) b(j)),
    light AS (SELECT year, "row", col, max(radiation) AS v FROM pixel WHERE source = 'VIIRS' AND mask GROUP BY ALL)
    SELECT e.year, e.province_code, e."row", e.col, CASE WHEN cells.code IS NULL THEN -9999.0 ELSE coalesce(v, -9999.0) END AS radiation FROM extent e
    LEFT JOIN cells ON cells.code = e.province_code AND cells."row" = e."row" AND cells.col = e.col LEFT JOIN light ON light.year = e.year AND light."row" = e."row" AND light.col = e.col""")
def clip_raster(spark, d):
    """The images of all years cut to each square: every cell of its extent, outside of it and where nothing is seen as nodata."""
    shapes, pixel = squares(spark, d, 10), A.pixels(spark, d).filter("source = 'VIIRS'")
    wanted, bounds = pixel.select("year", "province_code").distinct(), raster.snapped_bounds(shapes, 0.0, 64.0, 1.0, 64, 64)
    lines = raster.clip_raster(pixel.drop("province_code"), runs(spark, d, 10), bounds, wanted, ["year"])
    cells = lines.select("year", "province_code", "row", "col_first", F.posexplode("values").alias("i", "radiation"))
    return cells.select("year", "province_code", "row", (F.col("col_first") + F.col("i")).alias("col"), "radiation")


@query(f"""{S.PIXELS}, {inputs.CELLS}, areas AS (SELECT "row", col, max(area) AS area FROM pixel GROUP BY ALL)
    SELECT a.province_code AS code_a, b.province_code AS code_b, count(*) AS cells, round(sum(area), 6) AS area_km2
    FROM cells a JOIN cells b ON a."row" = b."row" AND a.col = b.col AND a.province_code < b.province_code JOIN areas ON areas."row" = a."row" AND areas.col = a.col GROUP BY ALL""")
def overlap_audit(spark, d):
    """Which provinces have pixels in the same cells, by the areas of these pixels."""
    area = A.pixels(spark, d).groupBy("row", "col").agg(F.max("pixel_area_km2").alias("pixel_area_km2"))
    return raster.overlap_audit(inputs.cells(spark, d), area)


RINGS = f"""{S.PIXELS}, {inputs.CELLS}, g AS (SELECT *, col - row_number() OVER (PARTITION BY province_code, "row" ORDER BY col) AS run FROM cells),
    runs AS (SELECT province_code, "row", min(col) AS first, max(col) + 1 AS last FROM g GROUP BY province_code, "row", run),
    bounds AS (SELECT province_code, CAST(min(first) AS DOUBLE) AS west, -CAST(max("row") + 1 AS DOUBLE) AS south, CAST(max(last) AS DOUBLE) AS east, -CAST(min("row") AS DOUBLE) AS north, count(*) AS rings, 5 * count(*) AS vertices FROM runs GROUP BY ALL)"""


def rings(spark, d):
    return raster.rings_of_cells(inputs.cells(spark, d))


@query(f"{RINGS} SELECT * FROM bounds")
def boundary_stats(spark, d):
    """Rings around the runs of each province's cells: their bounds, number and vertices."""
    own = rings(spark, d)
    return raster.province_bbox(own).join(raster.boundary_stats(own), "province_code")


@query(f"{RINGS} SELECT min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM bounds")
def all_bbox(spark, d):
    return raster.all_bbox(rings(spark, d))


@query(f"{RINGS} SELECT province_code, rings, vertices FROM bounds ORDER BY vertices DESC, province_code LIMIT 5")
def most_complex(spark, d):
    return raster.most_complex(rings(spark, d))


@query(f"""{RINGS}, {S.PROV}, known AS (SELECT province_code FROM prov WHERE number % 2 = 1), f AS (SELECT province_code FROM bounds WHERE rings % 3 <> 0)
    (SELECT province_code, 'not in catalogue' AS problem FROM f WHERE province_code NOT IN (SELECT * FROM known) ORDER BY 1 LIMIT 10)
    UNION ALL (SELECT province_code, 'not in file' FROM known WHERE province_code NOT IN (SELECT * FROM f) ORDER BY 1 LIMIT 10)""")
def code_mismatch(spark, d):
    """Rings of some provinces against a catalogue of others."""
    own = rings(spark, d)
    some = raster.boundary_stats(own).filter("rings % 3 != 0").select("province_code")
    return raster.code_mismatch(own.join(some, "province_code", "left_semi"), A.provinces(spark, d).filter("number % 2 = 1"))


#: Pixels by regions of different sizes, more than the calibration takes at least.
REGIONS = "CAST(floor(sqrt(l_partkey % 4096)) AS INT)"


@query(f"""WITH r AS (SELECT {REGIONS} AS k, l_linenumber % 2 = 1 AS dmsp, (l_quantity - 4) / 8.0 AS v FROM lineitem WHERE year(l_shipdate) IN (1998, 1999) AND l_discount <> 0.1),
    o AS (SELECT k, round(coalesce(sum(v) FILTER (dmsp), 0), 4) AS sol_dmsp, round(coalesce(sum(v) FILTER (NOT dmsp AND v >= 0.5), 0), 4) AS sol_viirs FROM r GROUP BY k HAVING count(*) FILTER (dmsp) > 0 AND count(*) FILTER (NOT dmsp) > 0)
    SELECT {S.fit('sol_dmsp', 'sol_viirs', 6)} FROM o WHERE sol_dmsp > 0 AND sol_viirs > 0""")
def fitted_calibration(spark, d):
    """The calibration with its minimum of 30 regions and a model that must rise, on regions of many sizes; both sensors from two years of shipments."""
    rows = A.table(spark, d, "lineitem").filter(F.year("l_shipdate").isin(1998, 1999)).select(
        F.floor(F.sqrt(F.col("l_partkey") % 4096)).cast("int").cast("string").alias("province_code"), F.lit(2013).alias("year"), F.lit(0).alias("month"),
        F.when(F.col("l_linenumber") % 2 == 1, "DMSP").otherwise("VIIRS").alias("source"), ((F.col("l_quantity") - 4) / 8.0).alias("radiation"), (F.col("l_tax") * 100).alias("cf_cvg"),
        (F.col("l_discount") != 0.1).alias("mask"), F.lit(1.0).alias("pixel_area_km2"),
    )
    pairs = models.overlap_pairs(zonal.zonal_stats(rows).filter("valid_pixels > 0").withColumn("area_km2", F.lit(1.0)))
    return S.rounded(models.fit_calibration(pairs), 6, "alpha", "beta", "r2")


@query(f"{PANEL} SELECT province_code, province_name, period, indicator, round(p.value, 4) AS value, coalesce(source, '') AS source FROM p WHERE p.value IS NOT NULL")
def export_panel(spark, d):
    """The long panel through its CSV and back."""
    path = shared_path(spark, "panel")
    export.export_panel_csv(panel_rows(spark, d), path, "dai", PANEL_CODES, PANEL_PERIODS)
    lines = spark.read.text(path).filter("value != '' AND NOT startswith(ltrim('﻿', value), '#') AND NOT startswith(value, 'province_code,')")
    row = F.from_csv("value", "province_code string, province_name string, period string, indicator string, unit string, value double, source string")
    return lines.select(row.alias("r")).select("r.province_code", "r.province_name", "r.period", "r.indicator", F.round("r.value", 4).alias("value"), F.coalesce("r.source", F.lit("")).alias("source"))


@query(f"""{S.ANNUAL_AND_ECONOMY}, day AS ({S.DAY}), {inputs.ENTRIES.replace('images AS', 'pictures AS')}
    SELECT 'light' AS part, count(*) AS lines FROM ac WHERE province_code = '05' AND year BETWEEN 2007 AND 2014 UNION ALL SELECT 'day', count(*) FROM day WHERE province_code = '05' AND year BETWEEN 2007 AND 2014
    UNION ALL SELECT 'economy', count(*) FROM econ WHERE province_code = '05' AND year BETWEEN 2007 AND 2014 UNION ALL SELECT 'images', count(*) FROM pictures WHERE month = 0 AND year BETWEEN 2007 AND 2014
    UNION ALL SELECT 'notes', CAST(coalesce(min(year) <= 2009 AND max(year) >= 2010, false) AS INT) + CAST(count(DISTINCT source) > 1 AS INT) FROM ac WHERE province_code = '05' AND year BETWEEN 2007 AND 2014""")
def export_bundle(spark, d):
    """How many lines each file of a province's bundle has, without headers; of its notes those on the series."""
    path = shared_path(spark, "bundle")
    export.export_bundle(A.provinces(spark, d), A.annual(spark, d, True), inputs.day_rows(spark, d), A.economy(spark, d), inputs.images(spark, d), "05", path, 2007, 2014)
    lines = None
    for part in ("light", "day", "economy", "images", "notes"):
        own = spark.read.text(f"{path}/{part}").filter("startswith(value, 'caution,')" if part == "notes" else "NOT startswith(ltrim('﻿', value), '#') AND NOT (value LIKE '%year,%')")
        counted = own.agg(F.count("*").alias("lines")).select(F.lit(part).alias("part"), "lines")
        lines = counted if lines is None else lines.unionByName(counted)
    return lines


@query(f"""{S.ANNUAL_AND_ECONOMY} SELECT e.province_code, e.year, round(ln(ac.sol), 6) AS ln_x, round(ln(e.grdp), 6) AS ln_y FROM econ e JOIN ac USING (province_code, year) WHERE ac.sol > 0 AND e.grdp > 0""")
def scatter_points(spark, d):
    rows = A.economy(spark, d).select("province_code", "year", "grdp").join(A.annual(spark, d).select("province_code", "year", "sol"), ["province_code", "year"])
    return S.rounded(shaping.scatter_points(rows).select("province_code", "year", "ln_x", "ln_y"), 6, "ln_x", "ln_y")


@query(f"""{S.JOINED}, g AS (SELECT count(*) AS n FROM j WHERE year >= 2014 AND sol_cal > 0 AND gdp > 0), o AS ({S.OVERLAP}), c AS (SELECT count(*) AS n FROM o WHERE sol_dmsp > 0 AND sol_viirs > 0)
    SELECT 'dmsp_to_viirs' AS model, n, '' AS price_basis, '2013' AS training_period FROM c UNION ALL SELECT 'gdp_log_regression', n, 'so_sanh', '2014-2025' FROM g""")
def calculation_models(spark, d):
    calibration = models.fit_log_model(models.overlap_pairs(A.stats(spark, d)), "sol_dmsp", "sol_viirs", 5)
    return models.calculation_models(calibration, models.gdp_model(joined(spark, d))).select("model", "n", "price_basis", "training_period")
