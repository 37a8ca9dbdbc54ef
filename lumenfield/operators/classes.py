"""Light classes with areas that are reconciled, and changes of class between two image sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import is_valid
from lumenfield.schemas import BACKGROUND, LIT_THRESHOLD


@dataclass(frozen=True)
class Scheme:
    """Classes by sensor, the same in all years. A value belongs to the last class whose lower bound it reaches; the first class has none."""

    version: str
    names: tuple[str, ...]
    bounds: Mapping[str, tuple[float, ...]]

    def __post_init__(self):
        for sensor, b in self.bounds.items():
            if len(b) != len(self.names) - 1 or list(b) != sorted(set(b)):
                raise ValueError(f"{sensor}: {len(self.names) - 1} rising bounds are needed")

    def number(self, value: Column, sensor: Column) -> Column:
        """1 for the first class; null for a null or NaN value or another sensor."""
        out = F.lit(None).cast("int")
        for name, bounds in self.bounds.items():
            reached = sum(((value >= F.lit(float(b))).cast("int") for b in bounds), F.lit(1))
            out = F.when((sensor == name) & ~F.isnan(value), reached).otherwise(out)
        return out

    def name(self, number: Column) -> Column:
        return F.get(F.array(*map(F.lit, self.names)), number - 1)


#: The first bounds are the sensors' background and lit thresholds (where the background is 0, half of the lit threshold); the upper ones are this version's.
SCHEME = Scheme(
    "1", ("dark", "weak", "medium", "strong", "very strong"), {"VIIRS": (BACKGROUND["VIIRS"], LIT_THRESHOLD["VIIRS"], 3.0, 5.0), "DMSP": (LIT_THRESHOLD["DMSP"] / 2, LIT_THRESHOLD["DMSP"], 15.0, 40.0)}
)


def classified(pixel: DataFrame, scheme: Scheme = SCHEME) -> DataFrame:
    """Pixels with ``light_class`` (1 to 5), ``class_name`` and ``scheme``. What is masked, not finite or nodata has no class, so it is never dark."""
    number = F.when(is_valid(), scheme.number(F.col("radiation"), F.col("source")))
    return pixel.withColumn("light_class", number).withColumns({"class_name": scheme.name(F.col("light_class")), "scheme": F.lit(scheme.version)})


def class_areas(pixel: DataFrame, keys: Sequence[str] = ("province_code", "year", "month", "source"), scheme: Scheme = SCHEME) -> DataFrame:
    """``(*keys, light_class, class_name, lower, upper, scheme, pixels, area_km2)``: a row for every class of every image, empty classes too.

    One aggregation of partial sums over the pixels. ``lower`` is in the class, ``upper`` is not; null where a class is open.
    """
    made = classified(pixel, scheme)
    sums = [F.count_if(F.col("light_class") == i).alias(f"n{i}") for i in range(1, len(scheme.names) + 1)]
    sums += [F.coalesce(F.sum(F.when(F.col("light_class") == i, F.col("pixel_area_km2"))), F.lit(0.0)).alias(f"a{i}") for i in range(1, len(scheme.names) + 1)]
    wide = made.groupBy(*dict.fromkeys([*keys, "source"])).agg(*sums)
    bound = lambda i: F.coalesce(*(F.when(F.col("source") == s, F.lit(b[i])) for s, b in scheme.bounds.items())) if 0 <= i < len(scheme.names) - 1 else F.lit(None).cast("double")
    rows = [
        F.struct(F.lit(i).alias("light_class"), F.lit(n).alias("class_name"), bound(i - 2).alias("lower"), bound(i - 1).alias("upper"), F.lit(scheme.version).alias("scheme"), F.col(f"n{i}").alias("pixels"), F.col(f"a{i}").alias("area_km2"))
        for i, n in enumerate(scheme.names, 1)
    ]
    own = [k for k in dict.fromkeys([*keys, "source"])]
    return wide.select(*own, F.inline(F.array(*rows)))


def closing_areas(pixel: DataFrame, areas: DataFrame, natural: DataFrame, keys: Sequence[str] = ("province_code", "year", "month", "source"), tolerance: float = 1e-9) -> DataFrame:
    """How the classes' areas close: ``(*keys, class_km2, valid_km2, difference_km2, closes, natural_km2, covered_pct, unseen_km2)``.

    ``class_km2`` adds up ``areas`` (of ``class_areas``, whoever made them); ``valid_km2`` is the area of the pixels with data, found without classes. They close if they differ by at most
    ``tolerance`` of the valid area. They aren't forced onto the ``natural`` area (``province_code, area_km2``): what lacks is ``unseen_km2``, negative where pixels reach
    beyond the boundary, and ``covered_pct`` is null for an area of 0 or none. An image on one side only has 0 on the other.
    """
    keys = list(keys)
    valid = pixel.groupBy(*keys).agg(F.coalesce(F.sum(F.when(is_valid(), F.col("pixel_area_km2"))), F.lit(0.0)).alias("valid_km2"))
    own = areas.groupBy(*keys).agg(F.sum("area_km2").alias("class_km2"))
    both = valid.join(own, keys, "full").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("valid_km2", "class_km2")})
    both = both.withColumn("difference_km2", F.col("class_km2") - F.col("valid_km2"))
    both = both.withColumn("closes", F.abs("difference_km2") <= tolerance * F.greatest(F.abs("valid_km2"), F.lit(1.0)))
    out = both.join(natural.select("province_code", F.col("area_km2").alias("natural_km2")), "province_code", "left")
    covered = F.when(F.col("natural_km2") > 0, 100 * F.col("valid_km2") / F.col("natural_km2"))
    return out.select(*keys, "class_km2", "valid_km2", "difference_km2", "closes", "natural_km2", covered.alias("covered_pct"), (F.col("natural_km2") - F.col("valid_km2")).alias("unseen_km2"))


def change_map(pixel: DataFrame, sensor: str, before: int, after: int, keys: Sequence[str] = (), scheme: Scheme = SCHEME) -> DataFrame:
    """Each grid cell that either of two years' images of one sensor has: ``(*keys, row, col, area_km2, before, after, class_before, class_after, seen, change)``.

    Both image sets are brought together in one aggregation of partial results, on their common grid (``row, col``; regridding comes before). Of several observations of a cell in a year the
    mean counts. ``seen`` is ``both``, ``before``, ``after`` or ``neither`` (by valid observations), and ``change`` is ``up``, ``down`` or ``same`` by classes, null unless both are seen, so that a gap
    is no change. Years of different sensors can't be compared: the sensor is one parameter for both.
    """
    if sensor not in scheme.bounds:
        raise ValueError(f"no classes for {sensor}")
    if before == after:
        raise ValueError("two different years are needed")
    own = pixel.filter((F.col("source") == sensor) & F.col("year").isin(before, after))
    value = lambda y: F.avg(F.when(is_valid() & (F.col("year") == y), F.col("radiation")))
    cells = own.groupBy(*keys, "row", "col").agg(F.max("pixel_area_km2").alias("area_km2"), value(before).alias("before"), value(after).alias("after"))
    a, b = F.col("before").isNotNull(), F.col("after").isNotNull()
    seen = F.when(a & b, "both").when(a, "before").when(b, "after").otherwise("neither")
    out = cells.withColumns({"class_before": scheme.number(F.col("before"), F.lit(sensor)), "class_after": scheme.number(F.col("after"), F.lit(sensor)), "seen": seen})
    change = F.when(F.col("class_after") > F.col("class_before"), "up").when(F.col("class_after") < F.col("class_before"), "down").when(F.col("class_after") == F.col("class_before"), "same")
    return out.withColumn("change", change)


def transitions(changes: DataFrame, keys: Sequence[str] = (), scheme: Scheme = SCHEME) -> DataFrame:
    """The matrix of a change map in long form: ``(*keys, class_before, class_after, cells, area_km2, share_pct)`` for all pairs of classes, empty ones too.

    The areas add up to the area seen in both years, and the shares to 100 of it (null where nothing is).
    """
    k = len(scheme.names)
    pair = (F.col("class_before") - 1) * k + F.col("class_after")
    sums = [F.count_if(pair == i).alias(f"n{i}") for i in range(1, k * k + 1)] + [F.coalesce(F.sum(F.when(pair == i, F.col("area_km2"))), F.lit(0.0)).alias(f"a{i}") for i in range(1, k * k + 1)]
    common = F.sum(F.when(F.col("seen") == "both", F.col("area_km2"))).alias("common")
    wide = changes.groupBy(*keys).agg(common, *sums)
    rows = [
        F.struct(F.lit((i - 1) // k + 1).alias("class_before"), F.lit((i - 1) % k + 1).alias("class_after"), F.col(f"n{i}").alias("cells"), F.col(f"a{i}").alias("area_km2"), F.when(F.col("common") > 0, 100 * F.col(f"a{i}") / F.col("common")).alias("share_pct"))
        for i in range(1, k * k + 1)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def change_summary(changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, common_km2, up_km2, down_km2, same_km2, only_before_km2, only_after_km2, unseen_km2, not_common_pct)``: changes of the area seen twice, and what wasn't."""
    area = lambda c, v: F.coalesce(F.sum(F.when(F.col(c) == v, F.col("area_km2"))), F.lit(0.0))
    parts = {"common_km2": ("seen", "both"), "up_km2": ("change", "up"), "down_km2": ("change", "down"), "same_km2": ("change", "same"), "only_before_km2": ("seen", "before"), "only_after_km2": ("seen", "after"), "unseen_km2": ("seen", "neither")}
    out = changes.groupBy(*keys).agg(F.sum("area_km2").alias("all"), *(area(*v).alias(k) for k, v in parts.items()))
    return out.withColumn("not_common_pct", F.when(F.col("all") > 0, 100 * (1 - F.col("common_km2") / F.col("all")))).drop("all")
