"""Zonal statistics: one pass over the pixels for each image (region, year, month, sensor)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import is_finite, is_valid, period
from lumenfield.schemas import BACKGROUND, KEY, LIT_THRESHOLD


def by_source(values: Mapping[str, float], source: str | Column = "source") -> Column:
    source = F.col(source) if isinstance(source, str) else source
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(source == name, F.lit(float(value))).otherwise(out)
    return out


def zonal_stats(pixel: DataFrame, image_meta: DataFrame | None = None, lit: Mapping[str, float] = LIT_THRESHOLD, background: Mapping[str, float] = BACKGROUND) -> DataFrame:
    """Statistics for each image, in one aggregation whose partial sums are made before the shuffle.

    Pixels without data count nothing. With ``image_meta``, an image without any pixel row still gives a row, and its tag is
    the fall-back for ``cloud_free_obs``. An image without valid pixels has ``valid_pixels`` 0 and null statistics.
    """
    ok, v = is_valid(), F.col("radiation")
    floor, bright = by_source(background), by_source(lit)
    above = (floor == 0) | (v >= floor)
    shining = ok & (v >= bright)
    cloud = F.col("cf_cvg")
    counted = ok & is_finite(cloud) & (cloud >= 0)
    only = lambda when, value: F.when(when, value)
    sums = pixel.groupBy(*KEY).agg(
        F.count_if(ok).alias("n"),
        F.sum(only(ok, v)).alias("raw"),
        F.sum(only(ok & above, v)).alias("above"),
        F.count_if(ok & ~above).alias("dark"),
        F.stddev_pop(only(ok, v)).alias("std"),
        F.min(only(ok, v)).alias("low"),
        F.max(only(ok, v)).alias("high"),
        F.count_if(shining).alias("lit"),
        F.sum(only(shining, v)).alias("lit_sum"),
        F.sum(only(shining, F.col("pixel_area_km2"))).alias("lit_area"),
        F.avg(only(counted, cloud)).alias("cloud"),
    )
    if image_meta is not None:
        tag = F.col("cf_cvg_mean_tag") if "cf_cvg_mean_tag" in image_meta.columns else F.lit(None).cast("double")
        sums = image_meta.withColumn("__tag", tag).join(sums, list(KEY), "left")
        sums = sums.withColumn("cloud", F.coalesce("cloud", F.when(is_finite("__tag"), F.col("__tag"))))
    return finish(sums.withColumn("n", F.coalesce("n", F.lit(0))), lit, background)


def finish(sums: DataFrame, lit: Mapping[str, float], background: Mapping[str, float]) -> DataFrame:
    some, n = F.col("n") > 0, F.col("n")
    given = lambda c: F.when(some, c)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    mean, std = F.col("raw") / n, F.col("std")
    cv = F.when(mean > 0, std / mean)
    stats = {
        "valid_pixels": n,
        "sol_raw": given(F.round("raw", 4)),
        "sol": given(F.round(zero("above"), 4)),
        "background_pixels": given(F.col("dark")),
        "background_threshold": by_source(background),
        "lit_threshold": by_source(lit),
        "rad_mean": given(F.round(mean, 6)),
        "rad_std": given(F.round(std, 6)),
        "rad_min": given(F.round("low", 4)),
        "rad_max": given(F.round("high", 4)),
        "rad_cv": given(F.round(cv, 4)),
        "spatial_cv": given(F.coalesce(F.round(cv, 4), F.lit(0.0))),
        "lit_pixels": given(F.col("lit")),
        "lit_sol": given(F.round(zero("lit_sum"), 4)),
        "lit_area_km2": given(F.round(zero("lit_area"), 4)),
        "lit_pixel_pct": given(F.round(100 * F.col("lit") / n, 4)),
        "cloud_free_obs": F.round("cloud", 4),
    }
    kept = [c for c in sums.columns if c not in ("n", "raw", "above", "dark", "std", "low", "high", "lit", "lit_sum", "lit_area", "cloud", "__tag", *stats)]
    return sums.select(*kept, *(c.alias(name) for name, c in stats.items()))


def with_area(stats: DataFrame) -> DataFrame:
    """Density and lit share by the natural area, from values that are already rounded, and the labels of each row."""
    month = F.col("month")
    return stats.withColumns(
        {
            "sol_density": F.round(F.col("sol") / F.col("area_km2"), 6),
            "lit_area_pct": F.round(100 * F.col("lit_area_km2") / F.col("area_km2"), 4),
            "period": period(),
            "frequency": F.when(month > 0, "monthly").otherwise("annual"),
            "status": F.when(F.col("valid_pixels") > 0, "OK").otherwise("INSUFFICIENT_QUALITY"),
        }
    )


def annual_rows(stats: DataFrame) -> DataFrame:
    """Rows of the annual table: DMSP years, and VIIRS from 2014. VIIRS 2013 serves the overlap only."""
    return stats.filter((F.col("month") == 0) & ((F.col("source") == "DMSP") | (F.col("year") >= 2014)))


def monthly_rows(stats: DataFrame) -> DataFrame:
    return stats.filter("month > 0")
