"""A corpus pipeline in stages; each reads what the one before it kept, written as Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfield.llm import bpe, mixing, quality, simhash, toxicity
from lumenfield.llm.common import ship_package, stash


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def whole_rows(docs: DataFrame) -> DataFrame:
    """What an operator reads, and the whole row beside it, so that columns an operator adds can't replace the documents' own."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    return quality.quality_rules(whole_rows(docs), labels_of(spark, sf_dir)).filter("kept").select("__row.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic."""
    labels = toxicity.category_labels(labels_of(spark, sf_dir))
    return toxicity.toxicity(whole_rows(docs), labels).filter("NOT toxic").select("__row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix with its ids and the text decoded from them."""
    ship_package(spark)
    # workers that served the other stages have less memory left
    return bpe.bpe_encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), cached=1 << 15).drop("text")


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Trees, hashes and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
