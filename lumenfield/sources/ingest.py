"""Reading, cleaning and validating the input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfield.functions.columns import is_finite, pad_code

#: Cells that stand for "no number".
SENTINELS = ("", "NA", "NaN", "nan", "None", "-9999", "-9999.0")
TEXT_COLUMNS = frozenset(
    "province_code province_name name_1 gid_1 slug source note calibration status obs_status period frequency reflectance_type grdp_price_basis kind path".split()
)
YEAR_NAMES = ("year", "nam", "YEAR")
CODE_NAMES = ("province_code", "ma_tinh")


def load_indicator_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All cells as strings, by the header; a byte-order mark before the first name goes. ``_seq`` keeps the order of rows in a file."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    return df.withColumn("_seq", F.monotonically_increasing_id())


def coerce(c: Column, kind: T.DataType) -> Column:
    """Text: trimmed, empty to null. Numbers: sentinels and what doesn't parse to null."""
    if isinstance(kind, T.StringType):
        return F.nullif(F.trim(c), F.lit(""))
    clean = F.trim(c)
    return F.when(~clean.isin(*SENTINELS), clean).try_cast("double").cast(kind)


def coerce_cells(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name: those that ``df`` lacks become null, those that the schema lacks go."""
    out = [coerce(F.col(f.name), f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*out, *(c for c in df.columns if c == "_seq"))


def first_truthy(df: DataFrame, names: Sequence[str]) -> Column:
    found = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in names if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def read_code_compat(df: DataFrame) -> DataFrame:
    """``province_code``, or else the legacy name, padded."""
    return df.withColumn("province_code", pad_code(first_truthy(df, CODE_NAMES)))


def normalise_keys(df: DataFrame) -> DataFrame:
    """Rows with a code and a year of digits; the code is padded, the year an integer."""
    code = pad_code(first_truthy(df, ["province_code"]))
    year = first_truthy(df, YEAR_NAMES)
    return df.withColumns({"province_code": code, "year": F.when(year.rlike("^[0-9]+$"), year).try_cast("int")}).filter("province_code != '' AND year IS NOT NULL")


def load_monthly(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Each month as its own row; rows whose month is no integer from 1 to 12 go."""
    keyed = normalise_keys(df)
    month = F.trim(F.col("month").cast("string"))
    keyed = keyed.withColumn("month", F.when(month.rlike("^[0-9]+$"), month).try_cast("int")).filter("month BETWEEN 1 AND 12")
    return typed(keyed, schema)


def typed(keyed: DataFrame, schema: T.StructType) -> DataFrame:
    """``coerce_cells`` for rows whose keys are already typed."""
    return coerce_cells(keyed.withColumns({c: F.col(c).cast("string") for c in ("year", "month") if c in keyed.columns}), schema)


def rollup_to_year(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row for each province and year: means of numbers to six digits, texts joined by ``/`` in order, and ``months_used``."""
    rows = typed(normalise_keys(df), schema)
    aggs = []
    for f in schema:
        if f.name in ("province_code", "year", "months_used"):
            continue
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.nullif(F.array_join(F.array_sort(F.collect_set(f.name)), "/"), F.lit("")).alias(f.name))
        else:
            aggs.append(F.round(F.avg(f.name), 6).cast(f.dataType).alias(f.name))
    return rows.groupBy("province_code", "year").agg(*aggs, F.count("*").cast("int").alias("months_used"))


def load_annual(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Annual rows; the months of a province and year, or its repeated rows, are rolled up."""
    return rollup_to_year(df, schema).select(*schema.fieldNames())


def first_usable(spark: SparkSession, candidates: Sequence[str], schema: T.StructType) -> tuple[str | None, DataFrame | None, dict]:
    """The first candidate with usable rows, and the report. A file without rows is passed over; one with rows but none usable ends the search."""
    from pyspark.errors import AnalysisException

    for path in candidates:
        try:
            df = load_indicator_csv(spark, path)
        except AnalysisException:  # no such path, or a file without a header
            continue
        if df.isEmpty():
            continue
        usable = load_annual(df, schema)
        report = load_report(df, schema, usable)
        return (path, usable, report) if report["state"] == "loaded" else (path, None, report)
    return None, None, {"state": "absent"}


def load_report(df: DataFrame, schema: T.StructType, usable: DataFrame) -> dict:
    """Which columns matched, which are missing and unused; or why a file is unreadable."""
    columns = [c for c in df.columns if c != "_seq"]
    target = schema.fieldNames()
    rows = usable.count()
    if rows:
        return {"state": "loaded", "rows": rows, "matched": [c for c in target if c in columns], "missing": [c for c in target if c not in columns], "unused": [c for c in columns if c not in target]}
    keys = [k for k, names in (("province_code", ["province_code"]), ("year", YEAR_NAMES)) if not set(names) & set(columns)]
    return {"state": "unreadable", "rows": df.count(), "missing_keys": keys, "headers": columns[:8]}


def dedupe_last(df: DataFrame, keys: Sequence[str], order: str = "_seq") -> DataFrame:
    """The last row of each key by an explicit order (a null one is first; ties go by the other columns, in their order).

    A maximum is taken before the shuffle already, so a key with many rows is no large group.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    last = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("__last"))
    return last.select(*(F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in df.columns))


MANIFEST_COLUMNS = ("province_code", "province_name", "year", "month", "source", "path", "area_km2")


def validate_manifest(df: DataFrame, existing: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` of an image manifest of strings; ``rejects`` has the column ``error``.

    ``existing`` (``path``) lists the files that exist; without it paths only have to be given. With ``strict`` any reject, or an
    empty manifest, raises.
    """
    missing = sorted(set(MANIFEST_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError("manifest without the columns: " + ", ".join(missing))
    text = lambda c: F.trim(F.col(c).cast("string"))
    rows = df.withColumns(
        {
            "__null": F.array_contains(F.array(*(F.col(c).isNull() for c in MANIFEST_COLUMNS if c != "month")), True),
            "province_code": pad_code(text("province_code")),
            "province_name": text("province_name"),
            "year": text("year").try_cast("int"),
            "month": F.coalesce(F.nullif(text("month"), F.lit("")), F.lit("0")).try_cast("int"),
            "source": F.upper(text("source")),
            "path": text("path"),
            "area_km2": text("area_km2").try_cast("double"),
        }
    )
    if existing is not None:
        rows = rows.join(existing.select(F.col("path"), F.lit(True).alias("__there")).distinct(), "path", "left")
    else:
        rows = rows.withColumn("__there", F.lit(True))
    same = F.count("*").over(Window.partitionBy("province_code", "year", "month", "source"))
    sensor = F.col("source").isin("VIIRS", "DMSP") & ~((F.col("source") == "DMSP") & ((F.col("month") != 0) | (F.col("year") > 2013))) & ~((F.col("source") == "VIIRS") & (F.col("year") < 2013))
    rules = [
        (F.col("__null"), "a cell is missing"),
        (~F.col("province_code").rlike("^[0-9]{2}$") | (F.col("province_name") == ""), "province code or name"),
        (F.col("year").isNull() | ~F.col("year").between(2004, 2025) | F.col("month").isNull() | ~F.col("month").between(0, 12), "year or month out of range"),
        (~sensor, "source does not fit the period"),
        (~is_finite("area_km2") | (F.col("area_km2") <= 0), "area_km2 must be positive and finite"),
        (same > 1, "repeated image"),
        (F.col("path") == "", "no path"),
        (F.col("__there").isNull(), "no such file"),
    ]
    error = F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(said)) for bad, said in rules))
    rows = rows.withColumn("error", error).drop("__null", "__there")
    valid, rejects = rows.filter("error IS NULL").drop("error"), rows.filter("error IS NOT NULL")
    if strict:
        first = rejects.select("error").first()
        if first:
            raise ValueError(f"manifest: {first['error']}")
        if valid.isEmpty():
            raise ValueError("manifest without images")
    return valid, rejects


def load_economy(df: DataFrame, by_basis: bool = False) -> DataFrame:
    """``province_code, year, population, gdp, price_basis, economy_source``; a repeated key or a number that isn't finite raises.

    The key is province and year; ``by_basis`` adds the price basis, so that GDP in current and in constant prices stand side by side.
    """
    has = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in df.columns else F.lit(None).cast("string")

    def number(c: str) -> Column:
        value = has(c).cast("double")
        bad = F.raise_error(F.concat(F.lit(f"{c} is not finite: "), has(c))).cast("double")
        return F.when(value.isNull() | is_finite(value), value).otherwise(bad)

    out = df.select(
        pad_code("province_code").alias("province_code"),
        F.col("year").cast("int").alias("year"),
        number("population").alias("population"),
        F.coalesce(number("grdp"), number("gdp")).alias("gdp"),
        F.coalesce(has("grdp_price_basis"), F.lit("")).alias("price_basis"),
        F.coalesce(F.col("source") if "source" in df.columns else F.lit(""), F.lit("")).alias("economy_source"),
    )
    key = ["province_code", "year", *(["price_basis"] if by_basis else [])]
    again = out.groupBy(*key).count().filter("count > 1").first()
    if again:
        raise ValueError("repeated economy key " + ", ".join(str(again[c]) for c in key))
    return out
