"""Coverage, summaries and map aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import pad_code
from lumenfield.schemas import INDICATORS


def provinces_with_counts(provinces: DataFrame, annual: DataFrame, day: DataFrame) -> DataFrame:
    """Each province with the number of its light and day rows, by number."""
    out = provinces
    for name, df in (("light_rows", annual), ("day_rows", day)):
        out = out.join(df.groupBy("province_code").agg(F.count("*").alias(name)), "province_code", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("light_rows", "day_rows")}).orderBy("number")


def province(provinces: DataFrame, code: str) -> DataFrame:
    """The row of one code, or none."""
    return provinces.filter(F.col("province_code") == pad_code(F.lit(code)))


def indicator_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """For each indicator, over its annual table: provinces with a value, first and last year; 0 and nulls without any."""
    home = {c: annual for c, annual, _, _ in INDICATORS}
    some = next(iter(tables.values()))
    out = some.sparkSession.createDataFrame([(i, c) for i, c in enumerate(home)], "indicator_order int, indicator string")
    parts = None
    for name, df in tables.items():
        own = [c for c, t in home.items() if t == name and c in df.columns]
        if own:
            long = df.select("province_code", "year", *(F.col(c).cast("double") for c in own)).unpivot(["province_code", "year"], own, "indicator", "value")
            parts = long if parts is None else parts.unionByName(long)
    seen = parts.filter("value IS NOT NULL").groupBy("indicator").agg(F.count_distinct("province_code").alias("provinces"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return out.join(seen, "indicator", "left").withColumn("provinces", F.coalesce("provinces", F.lit(0))).orderBy("indicator_order")


def coverage(annual: DataFrame, day: DataFrame, economy: DataFrame) -> DataFrame:
    """Rows by kind and year."""
    parts = [df.groupBy("year").agg(F.count("*").alias("rows")).withColumn("kind", F.lit(k)) for k, df in (("light", annual), ("day", day), ("economy", economy))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("kind", "year", "rows").orderBy("kind", "year")


def national_summary(rows: DataFrame, year: int, month: int = 0) -> DataFrame:
    """Sums over the provinces with light in one period; the density is of the sums. No row if there is none."""
    own = rows.filter(F.col("year") == year)
    if "month" in rows.columns:
        own = own.filter(F.col("month") == month)
    out = own.filter("sol IS NOT NULL").agg(
        F.sum("sol").alias("sol"), F.sum("area_km2").alias("area_km2"), F.count("*").alias("provinces"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("source")
    )
    density = F.when(F.col("area_km2") != 0, F.col("sol") / F.col("area_km2"))
    return out.filter("provinces > 0").select(F.lit(year).alias("year"), F.lit(month).alias("month"), "sol", "area_km2", density.alias("sol_density"), "provinces", "source")


def choropleth(tables: dict[str, DataFrame], indicator: str, year: int) -> DataFrame:
    """Values by province of one year, with the least, greatest and upper median; of a monthly indicator the latest month."""
    table = {c: annual for c, annual, _, _ in INDICATORS}[indicator]
    own = tables[table].filter((F.col("year") == year) & F.col(indicator).isNotNull())
    if table == "ntl_monthly":
        own = own.groupBy("province_code").agg(F.max_by(indicator, "month").alias(indicator))
    values = own.select("province_code", F.col(indicator).cast("double").alias("value"))
    sorted_ = F.array_sort(F.collect_list("value"))
    stats = values.agg(F.min("value").alias("least"), F.max("value").alias("greatest"), F.try_element_at(sorted_, (F.floor(F.count("value") / 2) + 1).cast("int")).alias("upper_median"))
    return values.crossJoin(F.broadcast(stats))  # one row
