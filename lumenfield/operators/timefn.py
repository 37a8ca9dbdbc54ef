"""Functions that reduce a series to one number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.functions.columns import decimal_year
from lumenfield.operators.quality import crossed_breaks

#: Names of the functions (sum, mean, total change in percent, compound annual growth in percent).
FUNCTIONS = ("tong", "trung_binh", "thay_doi", "cagr")


def reduce_series(values: str | Column, time: str | Column, names: Sequence[str] = FUNCTIONS) -> dict[str, Column]:
    """Aggregate expressions over rows of (time, value); null values and times don't count.

    Change and growth are null under two points, for a first value of zero or less, and growth for no time between.
    """
    v = F.col(values) if isinstance(values, str) else values
    t = F.col(time) if isinstance(time, str) else time
    v, t = F.when(t.isNotNull(), v), F.when(v.isNotNull(), t)
    first, last, span = F.min_by(v, t), F.max_by(v, t), F.max(t) - F.min(t)
    usable = (F.count(v) >= 2) & (first > 0)
    made = {
        "tong": F.round(F.sum(v), 4),
        "trung_binh": F.round(F.avg(v), 4),
        "thay_doi": F.when(usable, F.round(100 * (last / first - 1), 4)),
        "cagr": F.when(usable & (span > 0), F.round(100 * (F.pow(last / first, 1 / F.when(span > 0, span)) - 1), 4)),
    }
    return {n: made[n] for n in names if n in made}


def time_functions(long: DataFrame, names: Sequence[str] = FUNCTIONS, keys: Sequence[str] = ("province_code", "indicator")) -> DataFrame:
    """A row for each key of a long panel (``period``, ``value``) with one column for each function.

    Where the requested periods cross a break that the indicator doesn't bridge, change and growth are null and ``refused`` has the
    reasons. Unknown names are left out.
    """
    exprs = reduce_series("value", decimal_year("period"), names)
    year = F.substring("period", 1, 4).cast("int")
    out = long.groupBy(*keys).agg(*(c.alias(n) for n, c in exprs.items()), F.min(year).alias("__low"), F.max(year).alias("__high"))
    out = out.withColumn("refused", crossed_breaks("__low", "__high", "indicator"))
    for n in set(exprs) & {"thay_doi", "cagr"}:
        out = out.withColumn(n, F.when(F.size("refused") == 0, F.col(n)))
    return out.drop("__low", "__high")
