"""Word frequencies and stop-word removal over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_tokens, join_tokens, without_words
from ..session import broadcast_checked


def word_counts(df: DataFrame, cleaned: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(word, n) over all cleaned texts (A06); counted within each task before the shuffle."""
    tokens = without_words(clean_tokens(F.col(cleaned)), stop_words)
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def drop_stop_words(counts: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Anti join of counted words or tokens with a stop-word table."""
    words = stop_words.select(F.col("word").alias(word)).distinct()
    return counts.join(broadcast_checked(words), word, "left_anti")


def top_words(counts: DataFrame, n: int = 32) -> DataFrame:
    """The ``n`` most frequent words, ties by word."""
    return counts.orderBy(F.col("n").desc(), "word").limit(n)


def without_stop_words(df: DataFrame, cleaned: str, stop_words: Sequence[str]) -> DataFrame:
    """Cleaned text without its stop words, rewritten in place."""
    return df.withColumn(cleaned, join_tokens(without_words(clean_tokens(F.col(cleaned)), stop_words)))
