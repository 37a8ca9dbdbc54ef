"""Stored tables: sets that are published as a whole, and keyed upserts by partition."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfield.sources.shared import stash

MANIFEST = "_current.json"
#: Partitions that a scan is told by value, at most.
MOST_PARTITIONS = 300


class Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def system(self):
        return self.at("x").getFileSystem(self.conf)

    def exists(self, name: str) -> bool:
        return self.system().exists(self.at(name))

    def rename(self, name: str, to: str) -> None:
        fs = self.system()
        fs.mkdirs(self.at(to).getParent())
        if not fs.rename(self.at(name), self.at(to)):
            raise OSError(f"{self.path}/{name} could not be renamed to {to}")

    def delete(self, name: str) -> None:
        self.system().delete(self.at(name), True)

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.system().listStatus(self.at(name))) if self.exists(name) else []

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.system().open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a small file beside ``name`` and put it in its place in one step."""
        beside = f".{name}-{uuid.uuid4().hex}"
        stream = self.system().create(self.at(beside), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system().getUri(), self.conf).rename(self.at(beside), self.at(name), options)


def publish(tables: Mapping[str, DataFrame], folder: str, overwrite: bool = False) -> str:
    """Write a set of tables as a new version below ``folder`` and make it the one in use, in one step; gives the version.

    Every table is written and counted before a manifest, put in place by one rename, points to the new version. Whatever fails before that leaves the version in
    use as it was, with all its tables; readers that began with it keep their files, as versions stay until ``forget``. Without ``overwrite``, a set that is in use raises
    ``FileExistsError`` before anything is written. Tables that a new set lacks are no longer in use.
    """
    if not tables:
        raise ValueError("no tables")
    own = Folder(next(iter(tables.values())).sparkSession, folder)
    if not overwrite and own.exists(MANIFEST):
        raise FileExistsError(f"{folder}/{MANIFEST}")
    version = uuid.uuid4().hex
    rows = {}
    for name, df in tables.items():
        path = f"{own.path}/versions/{version}/{name}"
        df.write.parquet(path)
        rows[name] = own.spark.read.schema(df.schema).parquet(path).count()
    before = json.loads(own.read(MANIFEST) or "{}")
    own.replace(MANIFEST, json.dumps({"version": version, "before": before.get("version"), "number": before.get("number", 0) + 1, "tables": {n: {"rows": rows[n], "schema": df.schema.jsonValue()} for n, df in tables.items()}}))
    return version


def in_use(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the version in use; none if nothing was published."""
    found = json.loads(Folder(spark, folder).read(MANIFEST) or "{}")
    return {n: spark.read.schema(T.StructType.fromJson(x["schema"])).parquet(f"{folder.rstrip('/')}/versions/{found['version']}/{n}") for n, x in found.get("tables", {}).items()}


def forget(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> list[str]:
    """Delete versions that are neither in use nor the one before nor in ``keep``: those of failed publications, too. Not while one is being published."""
    own = Folder(spark, folder)
    found = json.loads(own.read(MANIFEST) or "{}")
    gone = [v for v in own.names("versions") if v not in {found.get("version"), found.get("before"), *keep}]
    for v in gone:
        own.delete(f"versions/{v}")
    return gone


def same(columns: Sequence[str], left: str, right: str) -> Column:
    """Equal in all columns, nulls included."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns), F.lit(True))


def upsert(rows: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], order: str | None = None) -> DataFrame:
    """Insert rows into a stored table by key, or replace those it has; the table is stored by ``partitions``, which are among the keys.

    Gives the report ``(*keys, action)``: ``inserted``, ``replaced`` or ``unchanged`` for each key of ``rows``. Of several rows of a key the last by ``order`` counts, ties by all columns. Only partitions with a row that
    is new or differs are written again, each replaced as a whole when all are ready; others keep their files, and a second run with the same rows writes nothing. Old rows are read from the partitions of new
    rows only. A run that is stopped midway is made good by running it again. Partition values must be neither null nor empty, as folders can't tell these apart. The rows need all columns
    of the table (``order`` isn't one).
    """
    if not set(partitions) <= set(keys) or not partitions:
        raise ValueError("partitions are some of the keys")
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != order]
    bad = reduce(lambda a, b: a | b, (F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in partitions))
    checked = rows.withColumn(partitions[0], F.when(bad, F.raise_error(F.lit("a partition value is null or empty"))).otherwise(F.col(partitions[0])))
    last = Window.partitionBy(*keys).orderBy(*([F.col(order).desc()] if order else []), *(F.col(c).desc_nulls_last() for c in columns))
    new = stash(checked.withColumn("__k", F.row_number().over(last)).filter("__k = 1").select(columns), "new-rows")
    folder = Folder(spark, path)
    if not folder.exists(""):
        spark.createDataFrame([], new.schema).write.partitionBy(*partitions).parquet(path)
    old = spark.read.schema(new.schema).parquet(path).select(columns)
    # some hundreds of partitions prune the scan by themselves; where there are more, the joins do
    some = new.select(*partitions).distinct().limit(MOST_PARTITIONS + 1).collect()
    if 0 < len(some) <= MOST_PARTITIONS:
        old = old.filter(reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(c) == r[c] for c in partitions)) for r in some)))
    n, o = new.alias("n"), old.alias("o")
    at = n.join(o, same(keys, "n", "o"), "left")
    known = F.col(f"o.{partitions[0]}").isNotNull()
    action = F.when(~known, "inserted").when(same(columns, "n", "o"), "unchanged").otherwise("replaced")
    report = stash(at.select(*(F.col(f"n.{k}").alias(k) for k in keys), action.alias("action")), "report")
    touched = stash(report.filter("action != 'unchanged'").select(*partitions).distinct(), "touched")
    if touched.isEmpty():
        return report
    stay = old.join(touched, list(partitions), "left_semi").alias("o").join(n, same(keys, "n", "o"), "left_anti")
    merged = stash(stay.select(columns).unionByName(new.join(touched, list(partitions), "left_semi").select(columns)), "merged")
    # a partition goes to few tasks, a large one to several
    dealt = merged.hint("rebalance", *partitions).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    return report
