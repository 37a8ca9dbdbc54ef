"""Where the light of a region is centred, and how that moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import is_valid

#: Mean radius of the Earth in kilometres.
RADIUS_KM = 6371.0088
MOMENTS = ("weight", "sum_x", "sum_y", "sum_z")


def light_moments(pixel: DataFrame, keys: Sequence[str], background: float = 0.0) -> DataFrame:
    """``(*keys, weight, sum_x, sum_y, sum_z)``: sums of unit vectors of the pixels (``lon, lat`` of their centres), weighted by light times area.

    These sums are all that a centroid needs, so parts of a region or of a year can be summed apart and put together by ``merged``. Only valid pixels above ``background`` count; a group
    without any has zeros. Where there is no ``pixel_area_km2``, light alone is the weight.
    """
    light = F.col("radiation") * F.col("pixel_area_km2") if "pixel_area_km2" in pixel.columns else F.col("radiation")
    good = is_valid() & (F.col("radiation") > background) & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    w = F.when(good, light.cast("double")).otherwise(0.0)
    lon, lat = F.radians("lon"), F.radians("lat")
    part = lambda c: F.sum(F.when(w > 0, w * c).otherwise(0.0))
    return pixel.groupBy(*keys).agg(F.sum(w).alias("weight"), part(F.cos(lat) * F.cos(lon)).alias("sum_x"), part(F.cos(lat) * F.sin(lon)).alias("sum_y"), part(F.sin(lat)).alias("sum_z"))


def merged(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of coarser groups, from finer ones."""
    return moments.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in MOMENTS))


def centroids(moments: DataFrame) -> DataFrame:
    """``moments`` with ``lon`` (above -180, to 180), ``lat`` and ``concentration``, from 0 to 1: how closely the light lies around them.

    All three are null without light, and the place is null where vectors cancel out (light evenly around the globe). Longitudes aren't averaged, so a
    region across the date line has its centre in it.
    """
    length = F.sqrt(F.col("sum_x") * F.col("sum_x") + F.col("sum_y") * F.col("sum_y") + F.col("sum_z") * F.col("sum_z"))
    near = F.when(F.col("weight") > 0, F.least(length / F.col("weight"), F.lit(1.0)))
    placed = near > 1e-9
    lon = F.degrees(F.atan2("sum_y", "sum_x"))
    lat = F.degrees(F.atan2(F.col("sum_z"), F.sqrt(F.col("sum_x") * F.col("sum_x") + F.col("sum_y") * F.col("sum_y"))))
    return moments.withColumns({"lon": F.when(placed, F.when(lon <= -180, lon + 360).otherwise(lon)), "lat": F.when(placed, lat), "concentration": near})


def great_circle_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """The shortest way over a sphere, by the haversine."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    # rounding may lift the sum above 1; a missing end stays null
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def bearing_deg(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """The direction in which that way begins: 0 is north, 90 is east."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))
    return F.pmod(angle + 360, F.lit(360.0))


def shifts(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("province_code", "source")) -> DataFrame:
    """``(*keys, from_lon, from_lat, to_lon, to_lat, distance_km, bearing_deg)`` between the centroids of two periods.

    A group that either side lacks, or that has no light on one side, has a null distance and bearing. The bearing is null too where nothing moved by a millimetre. Sensors aren't mixed as
    long as ``source`` is a key.
    """
    place = lambda df, name: df.select(*keys, F.col("lon").alias(f"{name}_lon"), F.col("lat").alias(f"{name}_lat"))
    both = place(before, "from").join(place(after, "to"), list(keys), "full")
    ends = [F.col(c) for c in ("from_lon", "from_lat", "to_lon", "to_lat")]
    out = both.withColumn("distance_km", great_circle_km(*ends))
    return out.withColumn("bearing_deg", F.when(F.col("distance_km") > 1e-6, bearing_deg(*ends)))
