"""Pieces of the DuckDB SQL that the queries are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.schemas import INDICATORS


def names(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def pct(now: str, before: str) -> str:
    return f"CASE WHEN {before} > 0 THEN round(100 * ({now} / ({before}) - 1), 4) END"


def fit(x: str, y: str, digits: int, what: str = "alpha beta r2 n") -> str:
    made = {
        "alpha": f"round(regr_intercept(ln({y}), ln({x})), {digits}) AS alpha",
        "beta": f"round(regr_slope(ln({y}), ln({x})), {digits}) AS beta",
        "r2": f"round(CASE WHEN regr_syy(ln({y}), ln({x})) > 0 THEN regr_r2(ln({y}), ln({x})) END, {digits}) AS r2",
        "n": "count(*) AS n",
    }
    return ", ".join(made[w] for w in what.split())


PROV = """prov AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_code, n_nationkey + 1 AS number, n_name AS province_name,
    CAST(1000 + 37 * n_nationkey AS DOUBLE) AS area_km2 FROM nation)"""


def _pixels(month: str, name: str = "every") -> str:
    return f"""{name} AS (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS province_code, year(l_shipdate) + 14 AS year, {month} AS month,
        CASE WHEN year(l_shipdate) + 14 <= 2013 AND l_linenumber % 2 = 1 THEN 'DMSP' ELSE 'VIIRS' END AS source, l_partkey % 64 AS "row", l_orderkey % 64 AS col, CAST(8 + l_partkey % 16 AS DOUBLE) AS lat,
        (l_quantity - 4) / 8.0 AS radiation, l_tax * 100 AS cf, l_discount <> 0.1 AS mask, (0.004 * 0.004) * (111.32 * 111.32) * cos(radians(CAST(8 + l_partkey % 16 AS DOUBLE))) AS area
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


_VALID = "pixel AS (SELECT * FROM every WHERE (source = 'DMSP' AND year <= 2013{only}) OR (source = 'VIIRS' AND year >= 2013))"
PIXELS_ALL = f"WITH {_pixels('0')}"
PIXELS = f"WITH {_pixels('0')}, {_VALID.format(only='')}"
_BRIGHT = "CASE source WHEN 'VIIRS' THEN 1.5 ELSE 5.0 END"
_FLOOR = "CASE source WHEN 'VIIRS' THEN 0.5 ELSE 0.0 END"
_STATS = f"""{PROV}, z AS (SELECT province_code, year, month, source, count(*) FILTER (mask) AS n, sum(radiation) FILTER (mask) AS raw,
        sum(radiation) FILTER (mask AND (source = 'DMSP' OR radiation >= 0.5)) AS above, count(*) FILTER (mask AND source = 'VIIRS' AND radiation < 0.5) AS dark,
        stddev_pop(radiation) FILTER (mask) AS std, min(radiation) FILTER (mask) AS low, max(radiation) FILTER (mask) AS high, count(*) FILTER (mask AND radiation >= {_BRIGHT}) AS lit,
        sum(radiation) FILTER (mask AND radiation >= {_BRIGHT}) AS lit_sum, sum(area) FILTER (mask AND radiation >= {_BRIGHT}) AS lit_area, avg(cf) FILTER (mask AND cf >= 0) AS cloud FROM pixel GROUP BY ALL),
    s0 AS (SELECT province_code, province_name, area_km2, year, month, source, n AS valid_pixels, CASE WHEN n > 0 THEN round(raw, 4) END AS sol_raw, CASE WHEN n > 0 THEN round(coalesce(above, 0), 4) END AS sol,
        CASE WHEN n > 0 THEN dark END AS background_pixels, {_FLOOR} AS background_threshold, {_BRIGHT} AS lit_threshold, round(raw / nullif(n, 0), 6) AS rad_mean, round(std, 6) AS rad_std,
        round(low, 4) AS rad_min, round(high, 4) AS rad_max, CASE WHEN raw > 0 THEN round(std / (raw / n), 4) END AS rad_cv, CASE WHEN n > 0 THEN coalesce(CASE WHEN raw > 0 THEN round(std / (raw / n), 4) END, 0) END AS spatial_cv,
        CASE WHEN n > 0 THEN lit END AS lit_pixels, CASE WHEN n > 0 THEN round(coalesce(lit_sum, 0), 4) END AS lit_sol, CASE WHEN n > 0 THEN round(coalesce(lit_area, 0), 4) END AS lit_area_km2,
        round(100 * lit / nullif(n, 0), 4) AS lit_pixel_pct, round(cloud, 4) AS cloud_free_obs FROM z JOIN prov USING (province_code)),
    s AS (SELECT *, round(sol / area_km2, 6) AS sol_density, CAST(round(CAST(CAST(100 * lit_area_km2 / area_km2 AS VARCHAR) AS DECIMAL(38, 20)), 4) AS DOUBLE) AS lit_area_pct,
        CASE WHEN month > 0 THEN year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') ELSE CAST(year AS VARCHAR) END AS period, CASE WHEN month > 0 THEN 'monthly' ELSE 'annual' END AS frequency,
        CASE WHEN valid_pixels > 0 THEN 'OK' ELSE 'INSUFFICIENT_QUALITY' END AS status, CASE WHEN month = 0 AND year = 2014 THEN 'DOI_NGUON_ANH_CHUA_HIEU_CHINH' ELSE '' END AS note,
        CASE WHEN valid_pixels = 0 THEN 'L' WHEN month = 0 AND year IN (2010, 2014) THEN 'B' WHEN cloud_free_obs < 2 THEN 'U' ELSE 'A' END AS obs_status FROM s0)"""
STATS = f"{PIXELS}, {_STATS}"
_MONTHLY_PIXELS = f"{_pixels('month(l_shipdate)')}, pixel AS (SELECT * FROM every WHERE source = 'VIIRS' AND year >= 2013)"
STATS_MONTHLY = f"WITH {_MONTHLY_PIXELS}, {_STATS}"
ZONAL_COLUMNS = (
    "province_code, province_name, area_km2, year, month, source, valid_pixels, sol_raw, sol, background_pixels, background_threshold, lit_threshold, rad_mean, rad_std, rad_min, rad_max, rad_cv, spatial_cv, "
    "lit_pixels, lit_sol, lit_area_km2, lit_pixel_pct, cloud_free_obs, sol_density, lit_area_pct, period, frequency, status, note, obs_status"
)
ZONAL_SQL = ZONAL_COLUMNS
OVERLAP = """SELECT d.province_code, 2013 AS year, d.sol AS sol_dmsp, v.sol AS sol_viirs, d.area_km2 FROM s d JOIN s v USING (province_code)
    WHERE d.year = 2013 AND v.year = 2013 AND d.source = 'DMSP' AND v.source = 'VIIRS'"""
PREVIOUS = "max({c}) OVER (PARTITION BY province_code ORDER BY year RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
_SAME = "max(sol) OVER (PARTITION BY province_code, source ORDER BY year RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
_ANNUAL = f"""ov AS ({OVERLAP}), cal AS (SELECT regr_intercept(ln(sol_viirs), ln(sol_dmsp)) AS a, regr_slope(ln(sol_viirs), ln(sol_dmsp)) AS b FROM ov WHERE sol_dmsp > 0 AND sol_viirs > 0 HAVING count(*) >= 5),
    ab AS (SELECT s.*, CASE WHEN source = 'VIIRS' THEN sol WHEN sol > 0 THEN exp(a) * pow(sol, b) WHEN sol = 0 THEN 0 END AS sol_cal0, 'DMSP_TO_VIIRS_POWER_OVERLAP2013_v1' AS calibration
        FROM s CROSS JOIN cal WHERE source = 'DMSP' OR year >= 2014),
    ac0 AS (SELECT *, CASE WHEN year <> 2014 THEN {pct('sol', _SAME)} END AS sol_change_pct, sol_cal0 AS sol_cal_full, {pct('sol_cal0', PREVIOUS.format(c='sol_cal0'))} AS sol_change_cal_pct, round(sol_cal0 / area_km2, 6) AS sol_density_cal FROM ab),
    ac AS (SELECT * EXCLUDE (sol_cal0, sol_cal_full), sol_cal_full AS sol_cal FROM ac0)"""
ANNUAL = f"{STATS}, {_ANNUAL}"
ANNUAL_COLUMNS = "province_code, year, source, sol, sol_change_pct, sol_change_cal_pct, sol_density_cal, calibration, obs_status, note"
_CAL = "max(sol) OVER (PARTITION BY province_code ORDER BY year * 12 + month RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING)"
_MONTHLY = f"""m AS (SELECT *, {pct('sol', _CAL.format(k=1))} AS sol_change_mom_pct, {pct('sol', _CAL.format(k=12))} AS sol_change_yoy_pct,
    round(avg(sol) OVER (PARTITION BY province_code ORDER BY year * 12 + month RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS sol_ma3,
    round(avg(sol_raw) OVER (PARTITION BY province_code ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS tnl_ma3,
    {pct('sol_raw', 'lag(sol_raw) OVER (PARTITION BY province_code ORDER BY year, month)')} AS tnl_mom_growth_pct FROM {{s}})"""
MONTHLY = f"{STATS_MONTHLY}, {_MONTHLY.format(s='s')}"
MONTHLY_COLUMNS = "province_code, year, month, period, sol, sol_change_mom_pct, sol_change_yoy_pct, sol_ma3, tnl_ma3, tnl_mom_growth_pct, obs_status"
ECONOMY = """econ AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS province_code, year(o_orderdate) + 14 AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS grdp,
    CAST(1000 * count(DISTINCT c_custkey) AS DOUBLE) AS population FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
ANNUAL_AND_ECONOMY = f"{ANNUAL}, {ECONOMY}"
JOINED = f"{ANNUAL_AND_ECONOMY}, j AS (SELECT ac.*, econ.population, econ.grdp AS gdp FROM ac LEFT JOIN econ USING (province_code, year))"


def _renamed(text: str) -> str:
    """The common tables of the monthly statistics under names of their own, to stand beside the annual ones."""
    for a in ("every", "pixel", "z", "s0", "s"):
        for before, after in ((f"{a} AS (", f"{a}_m AS ("), (f"FROM {a} ", f"FROM {a}_m "), (f"FROM {a})", f"FROM {a}_m)")):
            text = text.replace(f" {before}" if not before.startswith("FROM") else before, f" {after}" if not before.startswith("FROM") else after)
    return text


_MONTHLY_SIDE = _renamed(f" {_MONTHLY_PIXELS}, {_STATS.split('FROM nation),')[1].strip()}").strip()
BOTH = f"{ANNUAL}, {_MONTHLY_SIDE}, {_MONTHLY.format(s='s_m')}"
EVERYTHING = f"{BOTH}, {ECONOMY}"
DAY = "SELECT DISTINCT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS province_code, year(l_shipdate) + 14 AS year FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"
DAY_ROWS = """SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS province_code, year(l_shipdate) + 14 AS year, round(avg(p_size / 50), 6) AS ndvi
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def coverage_sql() -> str:
    """Every indicator over its annual table; those that the derived tables lack have no province."""
    one = lambda code, src: f"SELECT '{code}' AS indicator, count(DISTINCT province_code) AS provinces, min(year) AS first_year, max(year) AS last_year FROM {src}"
    source = {"ntl_annual": "ac WHERE {} IS NOT NULL", "ntl_monthly": "m WHERE {} IS NOT NULL", "economy": "econ", "day_annual": f"({DAY})"}
    lacking = ("NDBI_mean", "MNDWI_mean", "BSI_mean")
    parts = [f"SELECT '{c}', 0, NULL, NULL" if c in lacking else one(c, source[annual].format(c)) for c, annual, _, _ in INDICATORS]
    return f"{EVERYTHING} " + " UNION ALL ".join(parts)
