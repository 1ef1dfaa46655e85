"""Opinion lexicons and stop-word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_list(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """One word per line, Latin-1 by default, kept as written; blank lines are dropped."""
    return (
        spark.read.schema("word string")
        .option("encoding", encoding)
        .option("sep", "\u0001")
        .option("quote", "")
        .csv(path)
        .filter(F.length("word") > 0)
    )


def read_lexicon(spark: SparkSession, positive_path: str, negative_path: str) -> DataFrame:
    """(word, polarity). A word on both lists nets to 0, as separate +1 and -1 hits would."""
    signed = read_word_list(spark, positive_path).withColumn("polarity", F.lit(1)).unionByName(
        read_word_list(spark, negative_path).withColumn("polarity", F.lit(-1))
    )
    per_list = signed.distinct()
    return per_list.groupBy("word").agg(F.sum("polarity").cast("int").alias("polarity"))
