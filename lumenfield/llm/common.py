"""What several of the text operators share: the shared folder, written intermediate tables, seeds."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfield.sources.shared import shared_dir as shared_dir, shared_path as shared_path, stash as stash  # for all operators

#: A word is a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white space that separates words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, so that it needn't be installed on them."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-lumenfield-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sample_of(df: DataFrame, by: str, rows: int, seed: int = 7) -> DataFrame:
    """At most ``rows`` rows of ``df``, chosen by a seeded hash of ``by`` (the same rows in each run)."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(by)), F.col(by)).limit(rows)


def slices(texts: pd.Series, size: int = 1 << 21) -> Iterator[pd.Series]:
    """A batch of texts in runs of about ``size`` characters (a longer text is alone), so what is made from them stays small."""
    ends = texts.str.len().fillna(0).cumsum().to_numpy() // size
    cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        yield texts.iloc[a:b]


class Memo(dict):
    """A bounded cache of ``make(key)``: when full, entries not used since the last clearing go.

    Use ``memo[key]``. Two generations keep frequent keys while memory stays within ``2 * size`` entries.
    """

    def __init__(self, make, size: int = 1 << 18):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
