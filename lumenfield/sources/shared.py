"""The folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session (one machine, as in tests) may leave it unset; it then gets a temporary folder of its own, once."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-lumenfield-", dir=os.environ.get("TMPDIR")))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/lumenfield-{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again: this cuts the lineage, survives lost executors and shows the planner the true size."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
