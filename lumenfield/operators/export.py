"""Exports: a panel as one CSV with its notes, and a bundle of one province.

Both are answers to a request: a panel has a line for each province and indicator (wide) or each of their periods (long), a bundle one for each
year. That bound, not the size of the data behind it, is what a single file holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfield.operators.panel import panel_cells, panel_wide
from lumenfield.operators.quality import panel_warnings, series_warnings
from lumenfield.operators.tables import province_series
from lumenfield.schemas import LABELS, unit_of

BYTE_ORDER_MARK = "\ufeff"
#: Nights and days come from these images.
IMAGES = ("night: DMSP-OLS 2004-2013 (1 km), VIIRS DNB 2014-2025 (500 m)", "day: Landsat 2004-2014 (30 m), Sentinel-2 2015-2025 (10 m)")

BUNDLE_FILES = ("light: yearly indicators of the night images", "day: yearly indices of the day images", "economy: population and GDP, as provided", "images: the night and day images of these years")


def write_lines(spark: SparkSession, before: Sequence[str], rows: DataFrame | None, path: str, order: Sequence[str] = ()) -> None:
    """One text file: the lines of ``before``, of which the first gets a byte-order mark, and those of ``rows`` (``value``) by ``order``."""
    first = [(i, (BYTE_ORDER_MARK if i == 0 else "") + x) for i, x in enumerate(before)]
    out = spark.createDataFrame(first, "__line long, value string").orderBy("__line").select("value").coalesce(1)
    if rows is not None:
        out = out.union(rows.orderBy(*order).select("value"))
    out.coalesce(1).write.mode("overwrite").text(path)


def csv_line(*columns: str):
    """A line of CSV; nulls are empty cells."""
    return F.to_csv(F.struct(*(F.col(f"`{c}`") for c in columns)), {"nullValue": "", "emptyValue": ""}).alias("value")


def write_csv(df: DataFrame, path: str, note: str, order: Sequence[str]) -> bool:
    """CSV with a byte-order mark and a header, and a note in place of rows if there is none; whether there are rows."""
    some = not df.isEmpty()
    header = ",".join(df.columns)
    write_lines(df.sparkSession, [header] if some else [header, f"# {note}"], df.withColumn("value", csv_line(*df.columns)) if some else None, path, order)
    return some


def panel_notes(indicators: Sequence[str], periods: Sequence[str]) -> list[str]:
    """Two lines for each indicator (label, unit and code; description), then the warnings."""
    notes = []
    for c in indicators:
        label, description = LABELS[c]
        notes += [f"# {label} ({unit_of(c)}), code {c}", f"# {description}"]
    return notes + [f"# NOTE: {w}" for w in panel_warnings(indicators, [int(p[:4]) for p in periods])]


def export_panel_csv(long: DataFrame, path: str, shape: str, indicators: Sequence[str], periods: Sequence[str]) -> None:
    """One CSV at ``path``: notes, a blank line, a header, and the panel in the shape ``rong`` (wide: a column a period) or ``dai`` (long: a line a value)."""
    if shape not in ("rong", "dai"):
        raise ValueError("shape is 'rong' or 'dai'")
    if shape == "rong":
        keys = ["province_code", "province_name", "indicator", "unit", "source"]
        header, rows, order = [*keys, *periods], panel_wide(long, periods), ["number", "indicator_order"]
        rows = rows.select(csv_line(*header), *order)
    else:
        header = ["province_code", "province_name", "period", "indicator", "unit", "value", "source"]
        order = ["number", "indicator_order", "period_order"]
        rows = long.filter("value IS NOT NULL").select(csv_line(*header).alias("__csv"), *order).withColumnRenamed("__csv", "value")
    write_lines(long.sparkSession, [*panel_notes(indicators, periods), "", ",".join(header)], rows, path, order)


def export_bundle(provinces: DataFrame, annual: DataFrame, day: DataFrame, economy: DataFrame, images: DataFrame, code: str, path: str, first: int = 2004, last: int = 2025, made: str = "") -> list[str] | None:
    """Files of one province below ``path``: ``light``, ``day``, ``economy``, ``images`` and ``notes``; None for an unknown code.

    A part without rows still has its header, and says so. ``notes`` is a table of ``topic, detail``: the province, the years, the files and sensors, a ``caution`` for each warning about the
    series and a ``gap`` for each part that is missing. Returns the warnings and what is missing.
    """
    parts = province_series(provinces, annual, day, economy, code, first, last)
    if parts is None:
        return None
    missing = [f"no {name} rows in {first}-{last}" for name, df in parts.items() if not write_csv(df, f"{path}/{name}", f"no {name} rows in {first}-{last}", ["year"])]
    listed = images.filter((F.col("month") == 0) & F.col("year").between(first, last)).select("kind", "year", "path")
    if not write_csv(listed, f"{path}/images", "no images of these years", ["kind", "year"]):
        missing.append("no images of these years")
    own = provinces.filter(F.col("province_code") == F.lpad(F.trim(F.lit(code)), 2, "0")).first()
    whole = [df.filter((F.col("province_code") == own["province_code"]) & F.col("year").between(first, last)) for df in (annual, day, economy)]
    found = series_warnings(*whole).first()
    warnings = list(found["warnings"]) if found else []
    said = {"province": [f"{own['province_code']} {own['province_name']}"], "years": [f"{first}-{last}"], "created": [made] if made else [], "file": list(BUNDLE_FILES), "sensor": list(IMAGES), "caution": warnings, "gap": missing}
    quoted = lambda x: '"' + x.replace('"', '""') + '"'
    write_lines(provinces.sparkSession, ["topic,detail", *(f"{topic},{quoted(x)}" for topic, details in said.items() for x in details)], None, f"{path}/notes")
    return warnings + missing
