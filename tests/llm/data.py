"""Small tables with the awkward cases."""

import tempfile

from pyspark.sql import DataFrame, SparkSession

PROSE = "the quick brown fox jumps over the lazy dog and then it runs far away from here"

AWKWARD = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, "", "en", "b"),
    (4, None, None, None),
    (5, "   \n\t ", "fr", "b"),
    (6, PROSE.replace("fox", "cat"), "en", "b"),
    (None, "un autre texte sans numéro\ndeux lignes", "fr", None),
    (7, "word " * 3000 + "ende", "de", "c"),
    (8, "Ünïcödé ΣΊΣΥΦΟΣ 😀 <|endoftext|> é   x\x1cy", "de", "c"),
    (9, "a", None, "c"),
]


def awkward(spark: SparkSession) -> DataFrame:
    """Documents with nulls, empty, blank and long texts, repeated rows and columns with clashing names."""
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    extra = "n_chars long, size int, fp string, row int, kept string, score string, id int, component string, rep string, term string"
    return df.selectExpr("*", *(f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in extra.split(", ")))


def written(df: DataFrame, parts: int = 1) -> DataFrame:
    """A table that is read from files, so that the optimizer doesn't know its rows, in ``parts`` parts of which some may be empty."""
    path = tempfile.mkdtemp(prefix="spark-test-") + "/table"
    df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).repartition(parts)


def empty(spark: SparkSession) -> DataFrame:
    """A written table without rows: Python workers get its empty partitions, unlike with a filter that the optimizer folds."""
    return written(awkward(spark).filter("false"), 3)


def sparse(spark: SparkSession) -> DataFrame:
    """The awkward documents in more partitions than rows."""
    return written(awkward(spark), 4 * len(AWKWARD))
