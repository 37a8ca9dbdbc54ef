"""Quality flags of rows and warnings about requested periods and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.schemas import BREAK_YEARS, CALIBRATED, INDICATORS

#: Flags and what they mean.
FLAGS = {
    "B": "the series breaks here, as the satellite changes",
    "L": "there is an image, but no pixel of it is valid",
    "O": "there is no image",
    "U": "few cloud-free observations, so low confidence",
}
#: Labels that the data carry.
SIMULATED = "GIA_LAP"
UNCALIBRATED_NOTE = "DOI_NGUON_ANH_CHUA_HIEU_CHINH"
PENDING = ("PENDING", "CHUA_HIEU_CHINH")
CONSTANT_PRICES, CURRENT_PRICES = "so_sanh", "hien_hanh"
TOA_YEARS = (2015, 2018)

BREAK_2010 = "The series crosses 2010, where DMSP changes from satellite F16 to F18 without calibration."
BREAK_2014 = "The series crosses the change from DMSP (to 2013) to VIIRS (from 2014) without calibration."
USE_CALIBRATED = "The series crosses 2013 and is calibrated from DMSP to VIIRS: compare by sol_cal."
NOT_CALIBRATED = "The series is not calibrated between DMSP and VIIRS: compare within one source only."
TOA = "Day images of 2015-2018 are top-of-atmosphere reflectance, later ones surface reflectance."
PROVIDED = "Economic figures were provided, not derived from images."
SIMULATED_WARNING = "SIMULATED FIGURES: for demonstration only."
REFUSED = {2010: "the change of DMSP satellites in 2010 is not calibrated", 2014: "the change from DMSP to VIIRS in 2013/2014"}


def obs_status(df: DataFrame) -> DataFrame:
    """``L`` without valid pixels, else ``B`` for the annual rows at a break, else ``U`` under two observations, else ``A``."""
    at_break = (F.coalesce("month", F.lit(0)) == 0) & F.col("year").isin(*BREAK_YEARS)
    flag = F.when(F.coalesce("valid_pixels", F.lit(0)) == 0, "L").when(at_break, "B").when(F.col("cloud_free_obs") < 2, "U").otherwise("A")
    return df.withColumn("obs_status", flag)


def explained(df: DataFrame, flag: str = "obs_status") -> DataFrame:
    """``df`` with ``flag_text``: what each flag means; null for normal rows and unknown flags."""
    return df.withColumn("flag_text", F.try_element_at(F.create_map(*(F.lit(x) for pair in FLAGS.items() for x in pair)), F.col(flag)))


def note(df: DataFrame) -> DataFrame:
    """The note of the first VIIRS year of the annual table."""
    return df.withColumn("note", F.when((F.col("month") == 0) & (F.col("year") == 2014), UNCALIBRATED_NOTE).otherwise(""))


def crossed_breaks(first: str | Column, last: str | Column, indicator: str | Column) -> Column:
    """The breaks that lie in ``(first, last]`` and that the indicator's scale doesn't bridge, as reasons."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    found = []
    for year, reason in REFUSED.items():
        hit = (c(first) < year) & (F.lit(year) <= c(last))
        if year == 2014:
            hit = hit & ~c(indicator).isin(*sorted(CALIBRATED))
        found.append(F.when(hit, F.lit(reason)))
    return F.array_compact(F.array(*found))


def panel_warnings(indicators: Sequence[str], years: Sequence[int]) -> list[str]:
    """Warnings about a panel of these indicators over these years, each once, in order. Fires on calibrated columns too."""
    tables = {code: annual for code, annual, _, _ in INDICATORS}
    out: list[str] = []
    low, high = min(years), max(years)
    for code in indicators:
        table = tables[code]
        if table == "ntl_annual" and low <= 2009 and high >= 2010:
            out.append(BREAK_2010)
        if table == "ntl_annual" and low <= 2013 <= high:
            out.append(BREAK_2014)
        if table == "day_annual" and any(TOA_YEARS[0] <= y <= TOA_YEARS[1] for y in years):
            out.append(TOA)
        if table == "economy":
            out.append(PROVIDED)
    return list(dict.fromkeys(out))


def series_warnings(annual: DataFrame, day: DataFrame | None = None, economy: DataFrame | None = None) -> DataFrame:
    """``(province_code, warnings, simulated)`` from the rows that each province really has in its series."""
    light = annual.groupBy("province_code").agg(
        F.min("year").alias("low"),
        F.max("year").alias("high"),
        (F.count_distinct("source") > 1).alias("mixed"),
        F.bool_or(F.coalesce(F.col("calibration").isin(*PENDING), F.lit(False))).alias("pending"),
        F.bool_or(F.col("sol_cal").isNotNull()).alias("calibrated"),
        F.bool_or(F.coalesce(F.col("status") == SIMULATED, F.lit(False))).alias("fake"),
    )
    out = light
    if day is not None:
        toa = F.bool_or(F.col("year").between(*TOA_YEARS)).alias("toa")
        out = out.join(day.groupBy("province_code").agg(toa, F.bool_or(F.coalesce(F.col("status") == SIMULATED, F.lit(False))).alias("fake_day")), "province_code", "full")
    if economy is not None:
        out = out.join(economy.groupBy("province_code").agg(F.bool_or(F.coalesce(F.col("source") == SIMULATED, F.lit(False))).alias("fake_economy")), "province_code", "full")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in out.columns else F.lit(False)
    fake = yes("fake") | yes("fake_day") | yes("fake_economy")
    bridged = yes("mixed") & yes("calibrated") & ~yes("pending")
    found = [
        F.when(fake, SIMULATED_WARNING),
        F.when(yes("toa"), TOA),
        F.when((F.col("low") <= 2009) & (F.col("high") >= 2010), BREAK_2010),
        F.when(bridged, USE_CALIBRATED).when(yes("mixed") | yes("pending"), NOT_CALIBRATED),
    ]
    return out.select("province_code", F.array_compact(F.array(*found)).alias("warnings"), fake.alias("simulated"))


def simulated_labels(economy: DataFrame) -> DataFrame:
    """One row: the distinct source labels that hold the mark of simulated figures, sorted."""
    hit = F.upper("source").contains(SIMULATED)
    return economy.agg(F.array_sort(F.collect_set(F.when(hit, F.col("source")))).alias("simulated_labels"))


def price_basis_state(economy: DataFrame) -> DataFrame:
    """One row: whether all stated bases are constant prices (true), all current prices (false), or it isn't known (null)."""
    bases = F.array_sort(F.collect_set(F.when(F.trim("grdp_price_basis") != "", F.col("grdp_price_basis"))))
    state = F.when(bases == F.array(F.lit(CONSTANT_PRICES)), True).when(bases == F.array(F.lit(CURRENT_PRICES)), False)
    return economy.agg(bases.alias("bases"), state.alias("constant_prices"))


def missing_parts(provinces: DataFrame, annual: DataFrame, day: DataFrame, economy: DataFrame) -> DataFrame:
    """For each province whether it has no light, day or economy row."""
    out = provinces.select("province_code")
    for name, part in (("light", annual), ("day", day), ("economy", economy)):
        seen = part.select("province_code").distinct().withColumn(f"has_{name}", F.lit(True))
        out = out.join(seen, "province_code", "left")
    return out.select("province_code", *(F.col(f"has_{n}").isNull().alias(f"missing_{n}") for n in ("light", "day", "economy")))


def economy_warnings(economy: DataFrame) -> DataFrame:
    """One row: what a view of these economy rows has to say about simulated figures and prices."""
    fake, state = simulated_labels(economy), price_basis_state(economy)
    prices = F.when(F.col("constant_prices").isNull(), "It is not known whether GRDP is in constant or current prices.").when(~F.col("constant_prices"), "GRDP is in current prices, so the elasticity holds inflation too.")
    said = F.array_compact(F.array(F.when(F.size("simulated_labels") > 0, SIMULATED_WARNING), prices))
    return fake.crossJoin(F.broadcast(state)).select(said.alias("warnings"), "simulated_labels", "constant_prices")  # one row each
