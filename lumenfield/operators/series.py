"""Changes and moving averages of series, by calendar or by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.functions.columns import at_offset, pct, period_index


def annual_change(df: DataFrame, value: str = "sol", out: str = "sol_change_pct") -> DataFrame:
    """Against the year before of the same source; 2014 is always null."""
    before = at_offset(value, ["province_code", "source"], "year", -1)
    return df.withColumn(out, F.when(F.col("year") != 2014, pct(F.col(value), before)))


def calibrated_change(df: DataFrame, value: str = "sol_cal", out: str = "sol_change_cal_pct") -> DataFrame:
    """Against the year before, whatever its source."""
    return df.withColumn(out, pct(F.col(value), at_offset(value, ["province_code"], "year", -1)))


def monthly_changes(df: DataFrame, value: str = "sol") -> DataFrame:
    """Against the calendar month before and the same month a year before, and the mean of what three calendar months have."""
    df = df.withColumn("__t", period_index())
    last3 = Window.partitionBy("province_code").orderBy("__t").rangeBetween(-2, 0)
    out = df.withColumns(
        {
            f"{value}_change_mom_pct": pct(F.col(value), at_offset(value, ["province_code"], "__t", -1)),
            f"{value}_change_yoy_pct": pct(F.col(value), at_offset(value, ["province_code"], "__t", -12)),
            f"{value}_ma3": F.round(F.avg(value).over(last3), 4),
        }
    )
    return out.drop("__t")


def row_changes(df: DataFrame, value: str = "sol_raw", name: str = "tnl", key: str = "province_code", time: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """The mean of up to three rows and the change from the row before, even across missing months."""
    w = Window.partitionBy(key).orderBy(*time)
    return df.withColumns(
        {
            f"{name}_ma3": F.round(F.avg(value).over(w.rowsBetween(-2, 0)), 4),
            f"{name}_mom_growth_pct": pct(F.col(value), F.lag(value).over(w)),
        }
    )


def economy_change(annual: DataFrame, calibrated: bool = False) -> DataFrame:
    """``change_pct`` of the economy table: calibrated light whatever the source, or plain light of the same source only (2014 isn't left out)."""
    if calibrated:
        return annual.withColumn("change_pct", pct("sol_cal", at_offset("sol_cal", ["province_code"], "year", -1)))
    return annual.withColumn("change_pct", pct("sol", at_offset("sol", ["province_code", "source"], "year", -1)))
