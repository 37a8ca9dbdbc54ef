"""Projections to the output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import pad_code
from lumenfield.operators.series import economy_change

LIGHT_FIELDS = (
    "year", "source", "sol", "sol_density", "sol_change_pct", "sol_cal", "sol_density_cal", "sol_change_cal_pct", "sol_raw", "background_threshold", "background_pixels",
    "rad_mean", "rad_std", "rad_min", "rad_max", "rad_cv", "valid_pixels", "lit_pixels", "lit_area_km2", "lit_area_pct", "lit_sol", "lit_threshold", "area_km2", "note",
    "calibration", "status",
)
DAY_FIELDS = (
    "year", "source", "reflectance_type", "NDVI_mean", "NDVI_std", "NDBI_mean", "NDBI_std", "MNDWI_mean", "MNDWI_std", "BSI_mean", "BSI_std", "valid_area_pct",
    "valid_area_km2", "area_km2", "months_used", "status",
)
ECONOMY_FIELDS = ("year", "population", "gdp", "gdp_per_capita", "source")


def identity(rows: DataFrame, provinces: DataFrame) -> DataFrame:
    """Rows with the province's gid; a code that the catalogue lacks raises."""
    known = provinces.select(F.col("province_code").alias("__code"), F.col("gid_1"), F.lit(True).alias("__known"))
    out = rows.join(known, F.col("province_code") == F.col("__code"), "left")
    unknown = F.raise_error(F.concat(F.lit("no such province: "), F.coalesce("province_code", F.lit("null"))))
    return out.withColumn("gid_1", F.when(F.col("__known"), F.col("gid_1")).otherwise(unknown.cast("string"))).drop("__code", "__known")


def night_data(rows: DataFrame, provinces: DataFrame) -> DataFrame:
    """The 20 fields of the night dictionary. Pixel arrays are references to a band: band 1 for VIIRS, band 2 where an image has two."""
    path = F.col("path") if "path" in rows.columns else F.lit(None).cast("string")
    bands = F.col("band_count") if "band_count" in rows.columns else F.lit(None).cast("int")
    rows = rows.withColumns({"avg_rad": F.when(F.col("source") == "VIIRS", F.concat(path, F.lit("#band=1"))), "cf_cvg": F.when(bands == 2, F.concat(path, F.lit("#band=2")))})
    renamed = {
        "valid_pixels": "total_pixels", "cloud_free_obs": "cloud_free_obs", "sol_raw": "tnl", "rad_mean": "mean_rad", "rad_std": "std_rad", "rad_min": "min_rad", "rad_max": "max_rad",
        "spatial_cv": "spatial_cv", "lit_pixels": "lit_pixels", "lit_sol": "lit_pop_proxy", "lit_pixel_pct": "electrification_ratio_pct", "tnl_ma3": "tnl_ma3", "tnl_mom_growth_pct": "tnl_mom_growth_pct",
    }
    return identity(rows, provinces).select(
        "gid_1", F.col("province_name").alias("name_1"), "year", "month", "avg_rad", "cf_cvg", "area_km2", *(F.col(a).alias(b) for a, b in renamed.items())
    )


def night_economy(rows: DataFrame, provinces: DataFrame, calibrated: bool = False) -> DataFrame:
    """16 fields of light and economy and 5 of where they come from; density and change use calibrated light if asked to."""
    light = F.col("sol_cal") if calibrated else F.col("sol")
    annual = economy_change(rows.filter("month = 0"), calibrated)
    months = rows.filter("month > 0").withColumn("change_pct", F.lit(None).cast("double"))
    out = identity(annual.unionByName(months, allowMissingColumns=True), provinces)
    return out.select(
        "gid_1", F.col("province_name").alias("name_1"), "year", "month", "population", "gdp", "sol_raw", "sol", "lit_area_km2", "lit_area_pct",
        F.round("sol_cal", 4).alias("sol_cal"), F.round(light / F.col("area_km2"), 6).alias("sol_density"), F.col("change_pct").alias("sol_change_pct"), "sol_per_capita",
        "light_gdp_elasticity", "predicted_gdp", F.lit("sol_cal" if calibrated else "sol").alias("light_basis"), F.col("price_basis").alias("grdp_price_basis"),
        "economy_source", "calibration", "obs_status",
    )


def ntl_panel(annual: DataFrame, monthly: DataFrame) -> DataFrame:
    """DMSP years and VIIRS months from 2014."""
    return annual.filter("source = 'DMSP'").unionByName(monthly.filter("year >= 2014"), allowMissingColumns=True)


def province_series(provinces: DataFrame, annual: DataFrame, day: DataFrame, economy: DataFrame, code: str, first: int = 2004, last: int = 2025) -> dict[str, DataFrame] | None:
    """The light, day and economy rows of one province by year; None for an unknown code."""
    if provinces.filter(F.col("province_code") == pad_code(F.lit(code))).isEmpty():
        return None
    own = lambda df, fields: df.filter((F.col("province_code") == pad_code(F.lit(code))) & F.col("year").between(first, last)).select(*fields).orderBy("year")
    return {"light": own(annual, LIGHT_FIELDS), "day": own(day, DAY_FIELDS), "economy": own(economy, ECONOMY_FIELDS)}
