"""The province dimension, boundaries, image listings and registries, and the writer of tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfield.functions.columns import pad_code
from lumenfield.sources.ingest import dedupe_last
from lumenfield.sources.store import Folder


def province_dim(spark: SparkSession, path: str) -> DataFrame:
    """The provinces of a JSON catalogue (``number, ma_tinh, ten_tinh, slug, gid_1``), by number."""
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(
        pad_code(F.col("ma_tinh").cast("string")).alias("province_code"), F.col("number").cast("int").alias("number"), F.col("ten_tinh").alias("province_name"), "slug", "gid_1"
    ).orderBy("number")


def validate_crosswalk(features: DataFrame, crosswalk: DataFrame, provinces: DataFrame, expected: int = 63) -> DataFrame:
    """Problems as ``(problem, key)``; empty if all is well. Names and gids must be equal, not alike.

    ``features``: ``gid_1, source_name``; ``crosswalk``: ``gid_1, source_name, ma_tinh, ten_tinh``; ``provinces``: code and name.
    """
    said = lambda df, problem, key: df.select(F.lit(problem).alias("problem"), F.col(key).cast("string").alias("key"))
    twice = lambda df, c: df.groupBy(c).count().filter("count > 1")
    walk = crosswalk.withColumn("province_code", pad_code("ma_tinh"))
    both = features.select(F.col("gid_1"), F.col("source_name").alias("feature_name")).join(walk, "gid_1", "full")
    named = walk.join(provinces.select("province_code", "province_name"), "province_code")
    parts = [
        said(both.filter("ma_tinh IS NULL"), "feature not in crosswalk", "gid_1"),
        said(both.filter("feature_name IS NULL"), "crosswalk without feature", "gid_1"),
        said(both.filter("feature_name != source_name"), "names differ", "gid_1"),
        said(walk.join(provinces, "province_code", "left_anti"), "unknown province", "province_code"),
        said(provinces.join(walk, "province_code", "left_anti"), "province not covered", "province_code"),
        said(named.filter("ten_tinh != province_name"), "province name differs", "province_code"),
        said(twice(walk, "gid_1"), "repeated gid", "gid_1"),
        said(twice(walk, "province_code"), "repeated province", "province_code"),
        said(walk.agg(F.count("*").alias("n")).filter(F.col("n") != expected), "number of rows", "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


GEOJSON = (
    "type string, features array<struct<type: string, properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
)
LON, LAT = (100.0, 120.0), (5.0, 26.0)


def load_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """``(province_code, shape, ring_no, ring)`` of a GeoJSON FeatureCollection; a ring is an array of ``struct<x, y>``."""
    raw = spark.read.option("multiLine", True).schema(GEOJSON).json(path)
    features = raw.filter("type = 'FeatureCollection'").select(F.explode("features").alias("f"))
    code = pad_code(F.coalesce(F.col("f.properties")["province_code"], F.col("f.properties")["ma_tinh"]))
    rows = features.select(code.alias("province_code"), F.col("f.geometry.type").alias("shape"), F.col("f.geometry.coordinates").alias("c"))
    polygon = F.from_json("c", "array<array<array<double>>>")
    multi = F.flatten(F.from_json("c", "array<array<array<array<double>>>>"))
    rings = rows.select("province_code", "shape", F.posexplode(F.when(F.col("shape") == "Polygon", polygon).when(F.col("shape") == "MultiPolygon", multi)).alias("ring_no", "r"))
    return rings.select("province_code", "shape", "ring_no", F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def boundary_problems(rings: DataFrame, provinces: DataFrame, expected: int = 63) -> DataFrame:
    """``(problem, province_code)``: wrong number, bounds outside of the country, unknown codes, provinces not covered."""
    said = lambda df, problem: df.select(F.lit(problem).alias("problem"), "province_code")
    codes = rings.select("province_code").distinct()
    outside = F.exists("ring", lambda p: ~p["x"].between(*LON) | ~p["y"].between(*LAT))
    number = codes.agg(F.count("*").alias("n")).filter(F.col("n") != expected).select(F.col("n").cast("string").alias("province_code"))
    out = said(number, "number of features").unionByName(said(rings.filter(outside).select("province_code").distinct(), "out of bounds"))
    out = out.unionByName(said(codes.join(provinces, "province_code", "left_anti"), "unknown code"))
    return out.unionByName(said(provinces.select("province_code").join(codes, "province_code", "left_anti"), "not covered"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """``(path, size_bytes)`` of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("size_bytes"))


def image_inventory(files: DataFrame, preferred: str = "filtered", expected: int = 63) -> DataFrame:
    """Monthly images by ``_VIIRS_YYYY-MM`` in the name: ``(year, month, paths, n, complete)``. Where a month has files below the
    preferred folder only these count."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.withColumns({"year": F.regexp_extract(name, r"_VIIRS_([0-9]{4})-([0-9]{2})[_.]", 1).try_cast("int"), "month": F.regexp_extract(name, r"_VIIRS_([0-9]{4})-([0-9]{2})[_.]", 2).try_cast("int")})
    rows = rows.filter("year IS NOT NULL AND month BETWEEN 1 AND 12").withColumn("first", F.contains("path", F.lit(f"/{preferred}/")))
    own = F.array_sort(F.collect_set(F.when(F.col("first"), F.col("path"))))
    every = F.array_sort(F.collect_set("path"))
    out = rows.groupBy("year", "month").agg(F.when(F.size(own) > 0, own).otherwise(every).alias("paths"))
    return out.withColumn("n", F.size("paths")).withColumn("complete", F.col("n") >= expected).orderBy("year", "month")


def annual_image_inventory(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """One file a year: of the first pattern (a regular expression on names) that has one, then by path. The year is the first part of
    the name that is four digits."""
    name = F.element_at(F.split("path", "/"), -1)
    rank = F.coalesce(*(F.when(F.regexp_like(name, F.lit(p)), F.lit(i)) for i, p in enumerate(patterns)))
    year = F.try_element_at(F.filter(F.split(name, r"[_.\-]"), lambda x: x.rlike("^[0-9]{4}$")), F.lit(1)).cast("int")
    rows = files.withColumns({"rank": rank, "year": year}).filter("rank IS NOT NULL AND year IS NOT NULL")
    w = Window.partitionBy("year").orderBy("rank", "path")
    return rows.withColumn("k", F.row_number().over(w)).filter("k = 1").select("year", "path", "size_bytes").orderBy("year")


def image_registry(images: DataFrame, kind: str, step: str = "annual") -> DataFrame:
    """Annual (month 0) or monthly images of a kind, in order."""
    own = F.col("month") == 0 if step == "annual" else F.col("month").between(1, 12)
    return images.filter((F.col("kind") == kind) & own).orderBy("year", "month")


def image_path(images: DataFrame, kind: str, year: int, month: int = 0) -> DataFrame:
    return images.filter((F.col("kind") == kind) & (F.col("year") == year) & (F.col("month") == month)).select("path")


def image_counts(images: DataFrame) -> DataFrame:
    """Numbers of annual and monthly images of each kind."""
    return images.groupBy("kind").agg(F.count_if(F.col("month") == 0).alias("annual"), F.count_if(F.col("month").between(1, 12)).alias("monthly")).orderBy("kind")


def originals(images: DataFrame) -> DataFrame:
    """Source images by kind and year."""
    return images.orderBy("kind", "year")


def register_images(images: DataFrame, order: str = "_seq") -> DataFrame:
    """The last entry of each kind, year and month."""
    return dedupe_last(images, ["kind", "year", "month"], order)


def write_tables(tables: Mapping[str, DataFrame], folder: str, known: Sequence[str] = (), overwrite: bool = False, fmt: str = "parquet") -> None:
    """Write each table below ``folder``, known columns first and the others by name. Without ``overwrite`` nothing is written if any exists.

    All tables are written beside first; only when the last is whole are they renamed into place, and what they replace is deleted after that. So a table that can't be
    computed leaves all old ones as they were, and a table may be computed from the one that it replaces. (A reader between two renames may see one new and one old table;
    ``store.publish`` changes a set in one step.)
    """
    own = Folder(next(iter(tables.values())).sparkSession, folder)
    if not overwrite:
        for name in tables:
            if own.exists(name):
                raise FileExistsError(f"{folder}/{name}")
    run = uuid.uuid4().hex
    try:
        for name, df in tables.items():
            columns = [c for c in known if c in df.columns] + sorted(c for c in df.columns if c not in known)
            keys = [c for c in ("province_code", "year", "month") if c in df.columns]
            out = df.select(columns)
            out = out.orderBy(*keys) if keys else out
            path = f"{own.path}/.new-{run}/{name}"
            out.write.option("header", True).csv(path) if fmt == "csv" else out.write.parquet(path)
        for name in tables:
            if own.exists(name):
                own.rename(name, f".old-{run}/{name}")
            own.rename(f".new-{run}/{name}", name)
    finally:
        own.delete(f".new-{run}")
    own.delete(f".old-{run}")
