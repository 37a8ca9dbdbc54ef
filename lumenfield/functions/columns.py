"""Column expressions shared by the operators; all are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from lumenfield.schemas import NODATA


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: str | Column) -> Column:
    """Neither null, NaN nor infinite (NaN compares as larger than any number)."""
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def is_valid(radiation: str | Column = "radiation", mask: str | Column = "mask") -> Column:
    """A pixel with data: in the mask, finite and not nodata. Zero is data."""
    return F.coalesce(col(mask), F.lit(True)) & is_finite(radiation) & (col(radiation) != NODATA)


def pad_code(c: str | Column) -> Column:
    """A trimmed code, filled with zeros to two characters; longer ones stay."""
    c = F.trim(col(c))
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def growth_pct(now: str | Column, before: str | Column) -> Column:
    """``100 * (now / before - 1)``; null unless ``before`` is above zero. Unrounded."""
    now, before = col(now), col(before)
    return F.when(before > 0, 100 * (now / before - 1))


def pct(now: str | Column, before: str | Column) -> Column:
    return F.round(growth_pct(now, before), 4)


def period(year: str | Column = "year", month: str | Column = "month") -> Column:
    """``2010`` for a year, ``2024-07`` for a month; month 0 or null is the year."""
    year, month = col(year), F.coalesce(col(month), F.lit(0))
    return F.when(month > 0, F.format_string("%04d-%02d", year, month)).otherwise(year.cast("string"))


def period_index(year: str | Column = "year", month: str | Column = "month") -> Column:
    """Months since year 0."""
    return col(year) * 12 + col(month) - 1


def decimal_year(c: str | Column) -> Column:
    """``2010`` gives 2010.0, ``2024-07`` the middle of July; anything else null."""
    c = F.trim(col(c))
    month = F.try_to_number(F.substring(c, 6, 2), F.lit("99")).cast("double")
    whole = F.try_to_number(F.substring(c, 1, 4), F.lit("9999")).cast("double")
    return F.when(c.rlike(r"^[0-9]{4}$"), whole).when(c.rlike(r"^[0-9]{4}-(0[1-9]|1[0-2])$"), whole + (month - 0.5) / 12)


def at_offset(value: str, keys: list[str], time: str, offset: int) -> Column:
    """The value exactly ``offset`` steps of ``time`` away, not the neighbouring row's."""
    w = Window.partitionBy(*keys).orderBy(time).rangeBetween(offset, offset)
    return F.max(value).over(w)


def pixel_area_km2(pixel_width: str | Column, pixel_height: str | Column, crs_epsg: str | Column, lat: str | Column) -> Column:
    """The area of a north-up pixel: by latitude of its centre in EPSG:4326, or of a projected grid in metres. A null CRS raises."""
    size = F.abs(col(pixel_width) * col(pixel_height))
    geographic = size * F.lit(111.320**2) * F.cos(F.radians(col(lat)))
    return F.when(col(crs_epsg).isNull(), F.raise_error(F.lit("image without a CRS")).cast("double")).when(col(crs_epsg) == 4326, geographic).otherwise(size / 1e6)
