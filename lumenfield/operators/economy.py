"""Joins of light with the economy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import at_offset, growth_pct
from lumenfield.operators.models import MODEL_COLUMNS, elasticity_by_province, fit_log_model
from lumenfield.operators.quality import CONSTANT_PRICES, CURRENT_PRICES, SIMULATED


def attach_economy(light: DataFrame, economy: DataFrame) -> DataFrame:
    """Economy of the year on every row, months too; ``economy`` has ``province_code, year, population, gdp, price_basis, economy_source``."""
    own = economy.select("province_code", "year", "population", "gdp", "price_basis", "economy_source")
    out = light.join(own, ["province_code", "year"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("price_basis", "economy_source")})


def sol_per_capita(df: DataFrame) -> DataFrame:
    """Calibrated light for each person on annual rows; no light gives 0, no population null."""
    return df.withColumn("sol_per_capita", F.when((F.col("month") == 0) & (F.col("population") > 0), F.round(F.col("sol_cal") / F.col("population"), 6)))


def night_economy_view(economy: DataFrame, provinces: DataFrame, annual: DataFrame, first: int = 2014, last: int = 2025, minimum: int = 8) -> DataFrame:
    """Economy rows of known provinces with their light, by province number and year.

    ``sol_per_capita`` is unrounded here and null if either side is null or zero; ``beta_tinh`` is the slope of the
    province, null under ``minimum`` pairs.
    """
    money = economy.filter(F.col("year").between(first, last))
    rows = money.select("province_code", "year", "population", F.coalesce("grdp", "gdp").alias("grdp"), "grdp_price_basis", "source")
    rows = rows.join(provinces.select("province_code", "province_name", "number"), "province_code")
    rows = rows.join(annual.select("province_code", "year", "sol"), ["province_code", "year"], "left")
    some = (F.col("sol") != 0) & (F.col("population") != 0)
    rows = rows.withColumn("sol_per_capita", F.when(some, F.col("sol") / F.when(some, F.col("population"))))
    slopes = elasticity_by_province(rows, minimum=minimum).select("province_code", F.col("beta").alias("beta_tinh"))
    return rows.join(slopes, "province_code", "left").orderBy("number", "year")


def attach_both_bases(light: DataFrame, economy: DataFrame) -> DataFrame:
    """Economy of the year on every row of light, with a column for each price basis: ``gdp_constant, gdp_current, simulated_constant, simulated_current``, and ``population``.

    ``economy`` has a row for each province, year and basis (``load_economy(by_basis=True)``), so neither basis can take the other's place. Rows of another or no basis give their
    population only; of two populations of a year the one beside constant prices counts.
    """
    of = lambda basis, c: F.max(F.when(F.col("price_basis") == basis, F.col(c)))
    rows = economy.withColumn("__made", F.upper(F.coalesce("economy_source", F.lit(""))).contains(SIMULATED))
    wide = rows.groupBy("province_code", "year").agg(
        of(CONSTANT_PRICES, "gdp").alias("gdp_constant"), of(CURRENT_PRICES, "gdp").alias("gdp_current"), of(CONSTANT_PRICES, "__made").alias("simulated_constant"), of(CURRENT_PRICES, "__made").alias("simulated_current"),
        F.coalesce(of(CONSTANT_PRICES, "population"), F.max("population")).alias("population"),
    )
    return light.join(wide, ["province_code", "year"], "left")


def models_by_basis(joined: DataFrame, light: str = "sol_cal", first_year: int = 2014, minimum: int = 10) -> DataFrame:
    """``(price_basis, alpha, beta, r2, n, own_n, official)``: the regression of ln GDP on ln light in each basis, on the rows that both have.

    ``joined`` is of ``attach_both_bases``. Only annual rows from ``first_year`` with light and GDP above zero in both bases take part, so the models differ by the prices alone; ``own_n`` is how many rows
    a basis would have for itself. GDP that is simulated takes no part. Constant prices are the official result. No row under ``minimum`` common rows.
    """
    real = lambda b: (F.col(f"gdp_{b}") > 0) & ~F.coalesce(F.col(f"simulated_{b}"), F.lit(False))
    rows = joined.filter((F.coalesce("month", F.lit(0)) == 0) & (F.col("year") >= first_year) & (F.col(light) > 0))
    long = rows.select(F.col(light).alias("x"), F.coalesce(real("constant") & real("current"), F.lit(False)).alias("both"), F.inline(F.array(
        F.struct(F.lit(CONSTANT_PRICES).alias("price_basis"), F.when(real("constant"), F.col("gdp_constant")).alias("gdp")), F.struct(F.lit(CURRENT_PRICES).alias("price_basis"), F.when(real("current"), F.col("gdp_current")).alias("gdp")))))
    fit = fit_log_model(long.filter("both"), "x", "gdp", minimum, ["price_basis"])
    own = long.groupBy("price_basis").agg(F.count("gdp").alias("own_n"))
    return fit.join(own, "price_basis").select("price_basis", *MODEL_COLUMNS, "own_n", (F.col("price_basis") == CONSTANT_PRICES).alias("official"))


def growth_by_basis(joined: DataFrame) -> DataFrame:
    """``joined`` with ``growth_constant_pct`` and ``growth_current_pct`` from the calendar year before, and ``deflator`` (current by constant prices, 100 where equal). Annual rows only."""
    rows = joined.filter(F.coalesce("month", F.lit(0)) == 0)
    grown = lambda b: F.round(growth_pct(f"gdp_{b}", at_offset(f"gdp_{b}", ["province_code"], "year", -1)), 4)
    return rows.withColumns({"growth_constant_pct": grown("constant"), "growth_current_pct": grown("current"), "deflator": F.when(F.col("gdp_constant") > 0, 100 * F.col("gdp_current") / F.col("gdp_constant"))})


def derived_indicators(rows: DataFrame) -> DataFrame:
    """Annual rows with four indicators of light against the economy and the country:

    ``gdp_gap_pct``: GDP above (or below) what light predicts, in percent of that; ``light_per_gdp``: calibrated light by GDP; ``lit_intensity``: light of the lit area for each of its
    square kilometres; ``national_share_pct``: the province's share of the year's light of its source, and ``share_shift``, in percentage points from the calendar year before.
    Each is null where a part is missing or what it is divided by isn't above zero. A province without light is left out of the country's sum; months are no rows here.
    """
    annual = rows.filter(F.coalesce("month", F.lit(0)) == 0)
    by = lambda a, b, k=1.0: F.when(b > 0, k * a / F.when(b > 0, b))
    country = annual.groupBy("year", "source").agg(F.sum("sol").alias("__country"))
    out = annual.join(country, ["year", "source"], "left")
    out = out.withColumns(
        {
            "gdp_gap_pct": F.round(by(F.col("gdp") - F.col("predicted_gdp"), F.col("predicted_gdp"), 100.0), 4),
            "light_per_gdp": by(F.col("sol_cal"), F.when(F.col("gdp") > 0, F.col("gdp"))),
            "lit_intensity": F.round(by(F.col("lit_sol"), F.col("lit_area_km2")), 4),
            "national_share_pct": F.round(by(F.col("sol"), F.col("__country"), 100.0), 6),
        }
    ).drop("__country")
    return out.withColumn("share_shift", F.round(F.col("national_share_pct") - at_offset("national_share_pct", ["province_code", "source"], "year", -1), 6))
