"""Shaping of results for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search_province(provinces: DataFrame, text: str, name: str = "province_name") -> DataFrame:
    """Rows whose name holds the text, whatever case and accents."""
    plain = lambda c: F.collate(F.translate(c, "đĐ", "dD"), "UNICODE_CI_AI")
    return provinces.filter(F.contains(plain(F.col(name)), plain(F.trim(F.lit(text)))))


def order_vietnamese(df: DataFrame, name: str = "province_name", *then: str | Column) -> DataFrame:
    return df.orderBy(F.collate(F.col(name), "vi"), *then)


def recent_years(df: DataFrame, n: int, last: int = 2025) -> DataFrame:
    return df.filter(F.col("year") > last - n)


def limit_series(long: DataFrame, most: int = 8, focus: str | None = None) -> DataFrame:
    """Rows of at most ``most`` provinces: if there are more, the focused one, or else the first by name. ``kept`` and ``total`` count them."""
    names = long.select("province_code", "province_name").distinct()
    total = names.agg(F.count("*").alias("total"))
    if focus is not None:
        chosen = names.filter(F.col("province_code") == focus).select("province_code", F.lit(True).alias("first"))
    else:
        chosen = names.orderBy(F.collate("province_name", "vi"), "province_code").limit(most).select("province_code", F.lit(True).alias("first"))
    out = long.crossJoin(F.broadcast(total)).join(F.broadcast(chosen), "province_code", "left")  # a row; ``most`` rows
    kept = F.when(F.col("total") <= most, F.col("total")).otherwise(1 if focus is not None else most)
    return out.filter((F.col("total") <= most) | F.col("first")).withColumn("kept", kept.cast("long")).drop("first")


def scatter_points(df: DataFrame, x: str = "sol", y: str = "grdp") -> DataFrame:
    """Logarithms of the pairs that are both above zero."""
    return df.filter((F.col(x) > 0) & (F.col(y) > 0)).withColumns({"ln_x": F.ln(x), "ln_y": F.ln(y)})


def fit_line(df: DataFrame, x: str = "sol", y: str = "grdp") -> DataFrame:
    """The ends of the fitted line at the least and greatest x; one row."""
    ends = scatter_points(df, x, y).agg(
        F.min("ln_x").alias("x_low"), F.max("ln_x").alias("x_high"), F.regr_slope("ln_y", "ln_x").alias("beta"), F.regr_intercept("ln_y", "ln_x").alias("alpha")
    )
    at = lambda c: F.col("alpha") + F.col("beta") * F.col(c)
    return ends.withColumns({"y_low": at("x_low"), "y_high": at("x_high")})


def interpretation(beta: Column | float, light_pct: float = 10.0) -> Column:
    """So many percent of GRDP go with ``light_pct`` percent more light."""
    return (F.lit(beta) if isinstance(beta, float) else beta) * light_pct
