"""The given tables as domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfield.functions.columns import pixel_area_km2
from lumenfield.operators.models import apply_calibration, calibrated_density, fit_log_model, overlap_pairs
from lumenfield.operators.quality import note, obs_status
from lumenfield.operators.series import annual_change, calibrated_change, monthly_changes, row_changes
from lumenfield.operators.zonal import annual_rows, with_area, zonal_stats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return n.select(
        code.alias("province_code"),
        (F.col("n_nationkey") + 1).alias("number"),
        F.col("n_name").alias("province_name"),
        F.lower("n_name").alias("slug"),
        F.concat(F.lit("G."), code).alias("gid_1"),
        (1000 + 37 * F.col("n_nationkey")).cast("double").alias("area_km2"),
    )


def pixels(spark: SparkSession, sf_dir: str, monthly: bool | None = False) -> DataFrame:
    """Pixel observations of valid images: DMSP years to 2013 and VIIRS years from 2013 (month 0), or VIIRS months from 2013, or with None both, from one scan."""
    line, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    year = (F.year("l_shipdate") + 14).alias("year")
    source = F.when((F.year("l_shipdate") + 14 <= 2013) & (F.col("l_linenumber") % 2 == 1), "DMSP").otherwise("VIIRS")
    # a DMSP image is one of a year
    both = F.explode(F.when(source == "VIIRS", F.array(F.lit(0), F.month("l_shipdate"))).otherwise(F.array(F.lit(0))))
    month = (both if monthly is None else F.month("l_shipdate") if monthly else F.lit(0)).alias("month")
    lat = (8 + F.col("l_partkey") % 16).cast("double")
    rows = line.select(
        "l_suppkey", year, month, source.alias("source"), ((F.col("l_quantity") - 4) / 8.0).alias("radiation"), (F.col("l_tax") * 100).alias("cf_cvg"), (F.col("l_discount") != 0.1).alias("mask"),
        lat.alias("lat"), F.pmod("l_partkey", F.lit(64)).cast("int").alias("row"), F.pmod("l_orderkey", F.lit(64)).cast("int").alias("col"),
    )
    wanted = (F.col("source") == "VIIRS") & (F.col("year") >= 2013)
    if not monthly:
        wanted = wanted | ((F.col("source") == "DMSP") & (F.col("month") == 0))
    rows = rows.filter(wanted).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    area = pixel_area_km2(F.lit(0.004), F.lit(0.004), F.lit(4326), F.col("lat"))
    return rows.select(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("province_code"), "year", "month", "source", "row", "col", "lat", "radiation", "cf_cvg", "mask", area.alias("pixel_area_km2"))


#: Statistics that are kept, by application, folder and kind of image (False, True, or None for both).
KEPT: dict[tuple[str, str, bool | None], DataFrame] = {}


def release() -> None:
    """Give up the statistics that ``stats`` keeps."""
    while KEPT:
        KEPT.popitem()[1].unpersist()


def kept(spark: SparkSession, sf_dir: str, monthly: bool | None) -> DataFrame:
    """Zonal statistics, one row for each image, which series, models and panels read several times; kept until ``release``, so that the pixels are read once."""
    key = (spark.sparkContext.applicationId, sf_dir, monthly)
    if key not in KEPT:
        KEPT[key] = zonal_stats(pixels(spark, sf_dir, monthly)).persist()
    return KEPT[key]


def stats(spark: SparkSession, sf_dir: str, monthly: bool = False, both: bool = False) -> DataFrame:
    """Zonal statistics with areas, names and flags, of years or of months. With ``both`` they come from the one table of years and months, for a caller that takes the other too."""
    own = provinces(spark, sf_dir).select("province_code", "province_name", "area_km2")
    rows = kept(spark, sf_dir, None).filter("month > 0" if monthly else "month = 0") if both else kept(spark, sf_dir, monthly)
    return note(obs_status(with_area(rows.join(own, "province_code"))))


def annual(spark: SparkSession, sf_dir: str, calibrated: bool = False, both: bool = False) -> DataFrame:
    """The annual table. With ``calibrated`` the model is fitted on the provinces of the overlap (25 at most here, so from 5)."""
    every = stats(spark, sf_dir, both=both)
    model = fit_log_model(overlap_pairs(every), "sol_dmsp", "sol_viirs", 5) if calibrated else None
    rows = annual_change(annual_rows(every))
    return calibrated_change(calibrated_density(apply_calibration(rows, model)))


def monthly(spark: SparkSession, sf_dir: str, both: bool = False) -> DataFrame:
    return row_changes(monthly_changes(apply_calibration(stats(spark, sf_dir, True, both))))


def economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    out = rows.groupBy(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("province_code"), (F.year("o_orderdate") + 14).alias("year"))
    out = out.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("grdp"), (1000 * F.count_distinct("c_custkey")).cast("double").alias("population"))
    basis = F.when(F.col("year") % 2 == 0, "so_sanh").otherwise("hien_hanh")
    return out.withColumns({"gdp": F.col("grdp"), "gdp_per_capita": F.col("grdp") / F.col("population"), "grdp_price_basis": basis, "source": F.lit("orders")})


def economy_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Economy in the shape that the joins take, all in constant prices."""
    return economy(spark, sf_dir).select("province_code", "year", "population", "gdp", F.lit("so_sanh").alias("price_basis"), F.col("source").alias("economy_source"))


def day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day indices from the parts' sizes and prices, a row for each province and year of its shipments."""
    line, supplier, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    rows = line.select("l_suppkey", "l_partkey", (F.year("l_shipdate") + 14).alias("year")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    out = rows.groupBy(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("province_code"), "year").agg(F.round(F.avg(F.col("p_size") / 50), 6).alias("NDVI_mean"), F.count("*").alias("n"))
    return out.select("province_code", "year", F.lit("S2").alias("source"), "NDVI_mean", F.lit("OK").alias("status"))


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    both = not names or {"ntl_annual", "ntl_monthly"} <= set(names)
    made = {"ntl_annual": lambda: annual(spark, sf_dir, True, both), "ntl_monthly": lambda: monthly(spark, sf_dir, both), "day_annual": lambda: day(spark, sf_dir), "economy": lambda: economy(spark, sf_dir)}
    return {n: made[n]() for n in names or made}


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse daily series for each user of ``events``: ``(user_id, day, value)``."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(F.round(F.sum(F.round(F.col("value") * 8).cast("long")) / 8.0, 4).alias("value"))
