"""Schemas of the domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: Thresholds of the two sensors, the nodata value, and the years at which a sensor changes.
LIT_THRESHOLD = {"VIIRS": 1.5, "DMSP": 5.0}
BACKGROUND = {"VIIRS": 0.5, "DMSP": 0.0}
NODATA = -9999.0
BREAK_YEARS = (2010, 2014)
FIRST_YEAR, LAST_YEAR = 2004, 2025

KEY = ("province_code", "year", "month", "source")


def _struct(ddl: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in ddl.split(","))])


PIXEL = _struct("province_code string,year int,month int,source string,row int,col int,radiation double,cf_cvg double,mask boolean,pixel_area_km2 double")
IMAGE_META = _struct("province_code string,province_name string,year int,month int,source string,path string,area_km2 double,cf_cvg_mean_tag double,band_count int")
PROVINCE = _struct("province_code string,number int,province_name string,slug string,gid_1 string")
ECONOMY = _struct("province_code string,year int,population double,grdp double,gdp double,gdp_per_capita double,grdp_price_basis string,source string")
NTL_ANNUAL = _struct(
    "province_code string,province_name string,year int,source string,sol double,sol_raw double,background_threshold double,background_pixels double,sol_density double,"
    "sol_change_pct double,sol_cal double,sol_density_cal double,sol_change_cal_pct double,rad_mean double,rad_std double,rad_min double,rad_max double,rad_cv double,"
    "valid_pixels double,lit_pixels double,lit_area_km2 double,lit_area_pct double,lit_pixel_pct double,lit_sol double,lit_threshold double,cloud_free_obs double,"
    "area_km2 double,note string,calibration string,status string,obs_status string"
)
NTL_MONTHLY = _struct(
    "province_code string,province_name string,year int,month int,period string,source string,sol double,sol_raw double,background_threshold double,background_pixels double,"
    "sol_density double,sol_change_yoy_pct double,sol_change_mom_pct double,sol_ma3 double,rad_mean double,rad_std double,rad_min double,rad_max double,rad_cv double,"
    "valid_pixels double,lit_pixels double,lit_area_km2 double,lit_area_pct double,lit_pixel_pct double,lit_sol double,lit_threshold double,cloud_free_obs double,"
    "area_km2 double,calibration string,status string,obs_status string"
)
DAY_ANNUAL = _struct(
    "province_code string,province_name string,year int,source string,reflectance_type string,NDVI_mean double,NDVI_std double,NDBI_mean double,NDBI_std double,"
    "MNDWI_mean double,MNDWI_std double,BSI_mean double,BSI_std double,BLUE_mean double,GREEN_mean double,RED_mean double,NIR_mean double,SWIR1_mean double,SWIR2_mean double,"
    "valid_area_pct double,valid_area_km2 double,area_km2 double,months_used int,status string"
)

#: The indicator catalogue as (code, annual table, monthly table, digits).
INDICATORS = (
    ("sol", "ntl_annual", "ntl_monthly", 2),
    ("sol_density", "ntl_annual", "ntl_monthly", 4),
    ("sol_change_pct", "ntl_annual", None, 2),
    ("sol_cal", "ntl_annual", None, 2),
    ("sol_density_cal", "ntl_annual", None, 4),
    ("sol_change_cal_pct", "ntl_annual", None, 2),
    ("sol_raw", "ntl_annual", "ntl_monthly", 2),
    ("rad_mean", "ntl_annual", "ntl_monthly", 4),
    ("rad_max", "ntl_annual", "ntl_monthly", 2),
    ("rad_std", "ntl_annual", "ntl_monthly", 4),
    ("rad_cv", "ntl_annual", "ntl_monthly", 4),
    ("lit_pixels", "ntl_annual", "ntl_monthly", 0),
    ("lit_area_km2", "ntl_annual", "ntl_monthly", 2),
    ("lit_area_pct", "ntl_annual", "ntl_monthly", 2),
    ("lit_sol", "ntl_annual", "ntl_monthly", 2),
    ("valid_pixels", "ntl_annual", "ntl_monthly", 0),
    ("area_km2", "ntl_annual", "ntl_monthly", 1),
    ("sol_ma3", "ntl_monthly", "ntl_monthly", 2),
    ("sol_change_mom_pct", "ntl_monthly", "ntl_monthly", 2),
    ("sol_change_yoy_pct", "ntl_monthly", "ntl_monthly", 2),
    ("lit_pixel_pct", "ntl_annual", "ntl_monthly", 2),
    ("cloud_free_obs", "ntl_annual", "ntl_monthly", 2),
    ("NDVI_mean", "day_annual", None, 4),
    ("NDBI_mean", "day_annual", None, 4),
    ("MNDWI_mean", "day_annual", None, 4),
    ("BSI_mean", "day_annual", None, 4),
    ("population", "economy", None, 0),
    ("gdp", "economy", None, 0),
)
#: Columns that are on one scale on both sides of 2014.
CALIBRATED = frozenset(("sol_cal", "sol_density_cal", "sol_change_cal_pct"))


#: What each indicator is called in an export, and what it says.
LABELS = {
    "sol": ("Sum of lights", "radiance of the region's pixels above the background"),
    "sol_density": ("Light density", "sum of lights by natural area"),
    "sol_change_pct": ("Change of light", "against the year before, of the same source only"),
    "sol_cal": ("Sum of lights, calibrated", "DMSP on the VIIRS scale, for comparisons across 2013"),
    "sol_density_cal": ("Light density, calibrated", "calibrated sum of lights by natural area"),
    "sol_change_cal_pct": ("Change of light, calibrated", "against the year before, whatever the source"),
    "sol_raw": ("Sum of lights with background", "to see how much the background takes away"),
    "rad_mean": ("Mean radiance", "of the valid pixels"),
    "rad_max": ("Greatest radiance", "of the valid pixels"),
    "rad_std": ("Spread of radiance", "standard deviation over the valid pixels"),
    "rad_cv": ("Variation of radiance", "standard deviation by mean; high where light is concentrated"),
    "lit_pixels": ("Lit pixels", "pixels at or above the sensor's threshold, which differ between sensors"),
    "lit_area_km2": ("Lit area", "area of the lit pixels"),
    "lit_area_pct": ("Lit share of the area", "lit area by natural area"),
    "lit_sol": ("Light of the lit area", "radiance of the lit pixels only"),
    "valid_pixels": ("Valid pixels", "pixels with data; the two sensors differ in size"),
    "area_km2": ("Natural area", "area inside the boundary"),
    "sol_ma3": ("Sum of lights, three months", "mean of what three calendar months have"),
    "sol_change_mom_pct": ("Change from the month before", "null where that month has no image"),
    "sol_change_yoy_pct": ("Change from a year before", "against the same month, so without the seasons"),
    "lit_pixel_pct": ("Lit share of pixels", "lit pixels by valid pixels"),
    "cloud_free_obs": ("Cloud-free observations", "a quality field: under two the value is unsure"),
    "NDVI_mean": ("Mean NDVI", "vegetation"),
    "NDBI_mean": ("Mean NDBI", "buildings"),
    "MNDWI_mean": ("Mean MNDWI", "water"),
    "BSI_mean": ("Mean BSI", "bare soil"),
    "population": ("Population", "provided, not derived"),
    "gdp": ("GDP", "provided, not derived"),
}


def unit_of(code: str) -> str:
    """The unit of an indicator, from its name."""
    if code.endswith("_pct"):
        return "%"
    if code.startswith("sol_density"):
        return "nW/cm2/sr per km2"
    if code.endswith("_km2"):
        return "km2"
    if code.endswith("_pixels"):
        return "pixels"
    return {"rad_cv": "1", "cloud_free_obs": "observations", "population": "persons", "gdp": "billion VND"}.get(code, "index" if code.endswith("_mean") and code[0].isupper() else "nW/cm2/sr")
