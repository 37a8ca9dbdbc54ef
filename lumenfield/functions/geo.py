"""Map projections as column expressions (WGS 84)."""

from __future__ import annotations

from math import cos, radians, sin, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS 84 ellipsoid (semi-major axis in metres, flattening), and the standard parallel of the equal-area grid.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = sqrt(E2)
PARALLEL = 30.0
K0 = cos(radians(PARALLEL)) / sqrt(1 - E2 * sin(radians(PARALLEL)) ** 2)


def equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres of the cylindrical equal-area projection with the standard parallel of 30 degrees (EPSG:6933)."""
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E * s) / (1 + E * s)) / (2 * E))
    return F.radians(lon) * (MAJOR * K0), q * (MAJOR / (2 * K0))


#: The series of the transverse Mercator projection in the third flattening, to its fourth power.
N = FLATTENING / (2 - FLATTENING)
RECTIFYING = MAJOR / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45, 56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)
#: Fixed values of UTM: the scale on the central meridian, the false easting, and the false northing of the south.
UTM_SCALE, UTM_EAST, UTM_SOUTH = 0.9996, 500000.0, 10000000.0


def inverse_mercator(x: Column, y: Column, meridian: Column, scale: float = UTM_SCALE, east: float = UTM_EAST, north: Column | float = 0.0) -> tuple[Column, Column]:
    """Degrees of a point in metres of a transverse Mercator projection; well under a millimetre off within some 30 degrees of the meridian.

    Longitudes go on past 180 rather than jump, so that the least and greatest of an image bound it.
    """
    a, b = (y - north) / (scale * RECTIFYING), (x - east) / (scale * RECTIFYING)
    u = a - sum((k * F.sin(2 * (j + 1) * a) * F.cosh(2 * (j + 1) * b) for j, k in enumerate(BETA)), F.lit(0.0))
    v = b - sum((k * F.cos(2 * (j + 1) * a) * F.sinh(2 * (j + 1) * b) for j, k in enumerate(BETA)), F.lit(0.0))
    sphere = F.asin(F.sin(u) / F.cosh(v))
    lat = sphere + sum((k * F.sin(2 * (j + 1) * sphere) for j, k in enumerate(DELTA)), F.lit(0.0))
    return meridian + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(lat)


def is_utm(epsg: Column) -> Column:
    """WGS 84 / UTM zones 1 to 60, north (326..) or south (327..)."""
    return epsg.between(32601, 32660) | epsg.between(32701, 32760)


def to_degrees(x: Column, y: Column, epsg: Column) -> Column:
    """``struct<lon, lat>`` of a point in WGS 84 (4326) or one of its UTM zones. Null without a CRS; any other one fails the job."""
    meridian = (epsg % 100) * 6 - 183
    lon, lat = inverse_mercator(x, y, meridian, north=F.when(epsg > 32700, UTM_SOUTH).otherwise(0.0))
    utm = F.struct(lon.alias("lon"), lat.alias("lat"))
    other = F.raise_error(F.concat(F.lit("a CRS that is neither WGS 84 nor one of its UTM zones: "), epsg.cast("string"))).cast("struct<lon: double, lat: double>")
    return F.when(epsg.isNull(), None).when(epsg == 4326, F.struct(x.cast("double").alias("lon"), y.cast("double").alias("lat"))).when(is_utm(epsg), utm).otherwise(other)
