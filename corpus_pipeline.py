"""The corpus pipeline: filter, deduplicate, pseudonymise and pack the documents table.

Each stage is a function of (spark, docs, sf_dir), where docs is a scan of the Parquet table that
the stage before it wrote; all but the last return rows with the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.llm import exact, ngram_join, pii, quality
from filmlake.llm.common import documents
from filmlake.llm.queries import pack_documents
from filmlake.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier, fitted to this very table, accepts."""
    return quality.keep_accepted(docs, quality.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    return exact.keep_first(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies."""
    return ngram_join.keep_one(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its personal data replaced, and n_chars as the text now has them."""
    changed = pii.pseudonymise(docs)
    length = F.when(F.col("n_mentions") > 0, F.length("text").cast("long"))
    return changed.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece of every row and its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("PII", pii_surrogates),
    ("best-fit packing", best_fit_packing),
]

# The classifier, the tokenizer and the keyed surrogates cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
