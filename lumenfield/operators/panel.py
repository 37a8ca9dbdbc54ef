"""The panel query: indicators by region and period, densified, long or wide."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.schemas import FIRST_YEAR, INDICATORS, LAST_YEAR, unit_of

TABLES = {code: (annual, monthly) for code, annual, monthly, _ in INDICATORS}


def parse_period(text: str) -> tuple[int, int] | None:
    """``2010`` to (2010, 0), ``2024-07`` to (2024, 7); anything else None."""
    m = re.fullmatch(r"([0-9]{4})(?:-(0[1-9]|1[0-2]))?", str(text or "").strip())
    return (int(m[1]), int(m[2] or 0)) if m else None


def parse_periods(periods: Sequence[str] | None, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> list[tuple[int, int]] | None:
    """Distinct periods in order, a year before its months; None if any is malformed; all years if none is given."""
    if not periods:
        return [(y, 0) for y in range(first, last + 1)]
    parsed = [parse_period(p) for p in periods]
    return None if None in parsed else sorted(set(parsed))


def period_label(p: tuple[int, int]) -> str:
    return f"{p[0]}-{p[1]:02}" if p[1] else str(p[0])


def check_indicators(codes: Sequence[str]) -> list[str] | None:
    """The trimmed codes; None if there is none or any is unknown."""
    codes = [c.strip() for c in codes if str(c).strip()]
    return codes if codes and all(c in TABLES for c in codes) else None


def checked_requests(requests: DataFrame, column: str = "indicators") -> DataFrame:
    """``requests`` with ``accepted``: the trimmed codes of a comma-separated list, as ``check_indicators`` has them; null for a request without any or with an unknown one."""
    codes = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda c: F.trim(c)), lambda c: c != "")
    known = F.array(*(F.lit(c) for c in TABLES))
    return requests.withColumn("accepted", F.when((F.size(codes) > 0) & (F.size(F.array_except(codes, known)) == 0), codes))


def melt(tables: dict[str, DataFrame], indicators: Sequence[str]) -> DataFrame:
    """``(province_code, year, month, source, flag, indicator, value)`` of the tables that the indicators live in, one pass a table.

    The annual table of an indicator gives its years (month 0), the monthly one its months.
    """
    out = None
    for name, df in tables.items():
        monthly = name == "ntl_monthly"
        own = [c for c in dict.fromkeys(indicators) if name in TABLES[c] and c in df.columns]
        if not own:
            continue
        flag = F.col("obs_status") if "obs_status" in df.columns and name in ("ntl_annual", "ntl_monthly") else F.lit(None).cast("string")
        source = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
        month = F.col("month") if monthly else F.lit(0)
        base = df.select("province_code", "year", month.cast("int").alias("month"), source.alias("source"), flag.alias("flag"), *(F.col(c).cast("double") for c in own))
        if monthly:
            base = base.filter("month > 0")
        long = base.unpivot(["province_code", "year", "month", "source", "flag"], own, "indicator", "value")
        out = long if out is None else out.unionByName(long)
    return out


def panel_long(
    tables: dict[str, DataFrame],
    provinces: DataFrame,
    indicators: Sequence[str],
    periods: Sequence[str] | None = None,
    codes: Sequence[str] | None = None,
    first: int = FIRST_YEAR,
    last: int = LAST_YEAR,
) -> DataFrame | None:
    """A row for each selected province, indicator and period, null where there is no value; None if the request is malformed.

    The cross join is of three small dimensions of the request. ``flag`` is null for normal rows; ``source`` joins the sources of
    all of the province's rows in the request, also of those whose value is null.
    """
    wanted, at = check_indicators(indicators), parse_periods(periods, first, last)
    if wanted is None or at is None:
        return None
    spark = provinces.sparkSession
    regions = provinces.select("province_code", "province_name", "number")
    chosen = [c.strip().zfill(2) for c in codes or () if str(c).strip()]
    if chosen:
        regions = regions.filter(F.col("province_code").isin(*chosen))
    names = spark.createDataFrame([(c, i, unit_of(c)) for i, c in enumerate(wanted)], "indicator string, indicator_order int, unit string")
    times = spark.createDataFrame([(y, m, period_label((y, m)), i) for i, (y, m) in enumerate(at)], "year int, month int, period string, period_order int")
    grid = regions.crossJoin(F.broadcast(names)).crossJoin(F.broadcast(times))
    rows = melt(tables, wanted).join(F.broadcast(times.select("year", "month")), ["year", "month"])
    cells = rows.select("province_code", "indicator", "year", "month", "value", F.nullif("flag", F.lit("A")).alias("flag"), F.nullif("source", F.lit("")).alias("__source"))
    out = grid.join(cells, ["province_code", "indicator", "year", "month"], "left")
    sources = F.array_sort(F.collect_set("__source").over(Window.partitionBy("province_code")))
    out = out.withColumn("source", F.when(F.size(sources) > 0, F.array_join(sources, "/")))
    columns = ["province_code", "province_name", "number", "indicator", "indicator_order", "unit", "period", "period_order", "value", "flag", "source"]
    return out.select(columns).orderBy("number", "indicator_order", "period_order")


def panel_wide(long: DataFrame, periods: Sequence[str]) -> DataFrame:
    """One row for each province and indicator, one column for each period (known beforehand, so no extra job finds them)."""
    keys = ["number", "province_code", "province_name", "indicator_order", "indicator", "unit", "source"]
    return long.groupBy(*keys).pivot("period", list(periods)).agg(F.first("value")).orderBy("number", "indicator_order")


def panel_flags_wide(long: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The parallel table of flags."""
    return long.groupBy("number", "province_code", "indicator_order", "indicator").pivot("period", list(periods)).agg(F.first("flag")).orderBy("number", "indicator_order")


def panel_cells(long: DataFrame) -> DataFrame:
    """The long form for export: cells with a value only."""
    return long.filter("value IS NOT NULL").select("province_code", "province_name", "period", "indicator", "unit", "value", "source")


def panel_meta(long: DataFrame) -> DataFrame:
    """How many provinces have a value, and whether a month was asked for."""
    return long.agg(F.count_distinct(F.when(F.col("value").isNotNull(), F.col("province_code"))).alias("provinces_with_data"), F.bool_or(F.length("period") > 4).alias("has_months"))
