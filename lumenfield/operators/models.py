"""Log-log regressions: sensor calibration, prediction of GDP, elasticity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import at_offset, growth_pct
from lumenfield.operators.quality import CONSTANT_PRICES, SIMULATED

CALIBRATION_NAME = "DMSP_TO_VIIRS_POWER_OVERLAP2013_v1"  # fixed value
MODEL_COLUMNS = ("alpha", "beta", "r2", "n")


def fit_log_model(df: DataFrame, x: str, y: str, minimum: int, by: Sequence[str] = ()) -> DataFrame:
    """``(by, alpha, beta, r2, n)`` of ln y on ln x over pairs that are both above zero; one aggregation.

    Rows are left out where there are under ``minimum`` pairs or x doesn't vary. ``r2`` is null where y doesn't vary.
    """
    used = df.filter((F.col(x) > 0) & (F.col(y) > 0)).select(*by, F.ln(x).alias("__x"), F.ln(y).alias("__y"))
    fit = used.groupBy(*by).agg(
        F.regr_intercept("__y", "__x").alias("alpha"),
        F.regr_slope("__y", "__x").alias("beta"),
        F.when(F.regr_syy("__y", "__x") > 0, F.regr_r2("__y", "__x")).alias("r2"),
        F.count("*").alias("n"),
        F.regr_sxx("__y", "__x").alias("__sxx"),
    )
    return fit.filter((F.col("n") >= minimum) & (F.col("__sxx") > 0)).drop("__sxx")


def overlap_pairs(stats: DataFrame, year: int = 2013) -> DataFrame:
    """Provinces with an annual image of both sensors in the year they share."""
    one = stats.filter((F.col("month") == 0) & (F.col("year") == year))
    of = lambda s: F.max(F.when(F.col("source") == s, F.col("sol")))
    seen = lambda s: F.count_if(F.col("source") == s) > 0
    area = F.max(F.when(F.col("source") == "DMSP", F.col("area_km2")))
    out = one.groupBy("province_code").agg(seen("DMSP").alias("d"), seen("VIIRS").alias("v"), of("DMSP").alias("sol_dmsp"), of("VIIRS").alias("sol_viirs"), area.alias("area_km2"))
    return out.filter("d AND v").select("province_code", F.lit(year).alias("year"), "sol_dmsp", "sol_viirs", "area_km2")


def fit_calibration(pairs: DataFrame, minimum: int = 30) -> DataFrame:
    """The one-row model from DMSP to VIIRS; raises if it can't be fitted or doesn't rise."""
    model = fit_log_model(pairs, "sol_dmsp", "sol_viirs", minimum)
    row = model.first()
    if row is None or row["beta"] <= 0:
        raise ValueError(f"calibration takes {minimum} provinces with a pair above zero and a rising model")
    return model


def apply_calibration(df: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """``sol_cal`` on the VIIRS scale and ``calibration``; without a model DMSP rows stay null and PENDING."""
    viirs = F.col("source") == "VIIRS"
    if model is None:
        return df.withColumns({"sol_cal": F.when(viirs, F.col("sol")), "calibration": F.lit("PENDING")})
    # a model is one row
    one = F.broadcast(model.select(F.col("alpha").alias("__a"), F.col("beta").alias("__b")))
    dmsp = F.when(F.col("sol") > 0, F.exp("__a") * F.pow("sol", "__b")).when(F.col("sol") == 0, 0.0)
    out = df.crossJoin(one).withColumn("sol_cal", F.when(viirs, F.col("sol")).otherwise(dmsp))
    return out.withColumn("calibration", F.lit(CALIBRATION_NAME)).drop("__a", "__b")


def calibrated_density(df: DataFrame) -> DataFrame:
    return df.withColumn("sol_density_cal", F.round(F.col("sol_cal") / F.col("area_km2"), 6))


def gdp_training(joined: DataFrame) -> DataFrame:
    """Annual rows from 2014 with GDP in constant prices that isn't simulated."""
    real = ~F.upper(F.coalesce("economy_source", F.lit(""))).contains(SIMULATED)
    return joined.filter((F.col("month") == 0) & (F.col("year") >= 2014) & (F.col("price_basis") == CONSTANT_PRICES) & real)


def gdp_model(joined: DataFrame, minimum: int = 10) -> DataFrame:
    return fit_log_model(gdp_training(joined), "sol_cal", "gdp", minimum)


def predicted_gdp(df: DataFrame, model: DataFrame) -> DataFrame:
    """``exp(alpha + beta ln sol_cal)`` of annual rows, without a correction of the logarithm's bias; null without a model."""
    one = F.broadcast(model.agg(F.max("alpha").alias("__a"), F.max("beta").alias("__b")))  # one row
    light = F.when((F.col("month") == 0) & (F.col("sol_cal") > 0), F.col("sol_cal"))
    return df.crossJoin(one).withColumn("predicted_gdp", F.round(F.exp(F.col("__a") + F.col("__b") * F.ln(light)), 6)).drop("__a", "__b")


def elasticity_pooled(df: DataFrame, x: str = "sol", y: str = "grdp", minimum: int = 10) -> DataFrame:
    """One row: the pooled elasticity, rounded, with nulls under ``minimum`` pairs, and its warnings."""
    n = df.agg(F.count_if((F.col(x) > 0) & (F.col(y) > 0)).alias("pairs"))
    fit = fit_log_model(df, x, y, 2)
    enough = F.col("n") >= minimum
    out = n.join(fit, F.lit(True), "left")
    values = [F.when(enough, F.round(c, 6)).alias(c) for c in ("alpha", "beta", "r2")]
    few = F.when(~F.coalesce(enough, F.lit(False)), f"under {minimum} usable observations")
    low = F.when(enough & (F.col("r2") < 0.5), "R2 under 0.5: the relation is weak")
    return out.select(*values, F.coalesce("n", F.lit(0)).alias("n"), F.array_compact(F.array(few, low)).alias("warnings"))


def elasticity_by_province(df: DataFrame, x: str = "sol", y: str = "grdp", minimum: int = 8, pooled_minimum: int = 10) -> DataFrame:
    """The elasticity of each province with enough pairs; empty if the pooled one can't be given."""
    own = fit_log_model(df, x, y, minimum, ["province_code"]).select("province_code", F.round("beta", 6).alias("beta"), F.round("r2", 6).alias("r2"), "n")
    return own.join(F.broadcast(fit_log_model(df, x, y, pooled_minimum).select(F.lit(True).alias("__ok"))), F.lit(True), "left_semi")


def calculation_models(calibration: DataFrame | None, gdp: DataFrame, stats_version: str = "1") -> DataFrame:
    """The models that exist, a row each."""
    named = lambda m, name, basis, years: m.select(F.lit(name).alias("model"), *MODEL_COLUMNS, F.lit(stats_version).alias("stats_version"), F.lit(basis).alias("price_basis"), F.lit(years).alias("training_period"))
    out = named(gdp, "gdp_log_regression", CONSTANT_PRICES, "2014-2025")
    return out if calibration is None else named(calibration, "dmsp_to_viirs", "", "2013").unionByName(out)


def light_gdp_elasticity(annual: DataFrame) -> DataFrame:
    """Growth of calibrated light by growth of GDP between two years in constant prices; not at 2010."""
    before = {c: at_offset(c, ["province_code"], "year", -1) for c in ("sol_cal", "gdp", "price_basis")}
    both = (F.col("price_basis") == CONSTANT_PRICES) & (before["price_basis"] == CONSTANT_PRICES) & (F.col("year") != 2010)
    gdp = growth_pct(F.col("gdp"), before["gdp"])
    ratio = growth_pct(F.col("sol_cal"), before["sol_cal"]) / F.when(gdp != 0, gdp)
    return annual.withColumn("light_gdp_elasticity", F.when(both, F.round(ratio, 6)))
