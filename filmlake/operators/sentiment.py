"""Lexicon sentiment of texts and its corrected mean per genre."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..session import broadcast_checked, materialize, small_rows


def lexicon_score(tokens: Column, words_by_polarity: Mapping[int, Sequence[str]]) -> Column:
    """Sum of the polarities of the listed words among the tokens, every occurrence counted."""

    def hits(words: Sequence[str]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(list(words))))

    score = F.lit(0)
    for polarity, words in sorted(words_by_polarity.items()):
        score = score + F.lit(polarity) * hits(words)
    return score.cast("long")


def _score_in_rows(df, words, key, text, keep):
    by_polarity: dict[int, list[str]] = {}
    for row in words:
        by_polarity.setdefault(row.polarity, []).append(row.word)
    split = df.select(key, *keep, F.coalesce(word_tokens(F.col(text)), F.array()).alias("_t"))
    return split.select(key, lexicon_score(F.col("_t"), by_polarity).alias("score"), *keep)


def _score_by_join(df, lexicon, key, text, keep):
    rows = df.select(key, *keep, word_tokens(F.col(text)).alias("_t"))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    hits = rows.select("_row", F.explode("_t").alias("word")).join(broadcast_checked(lexicon), "word")
    scores = hits.groupBy("_row").agg(F.sum("polarity").alias("score"))
    return (
        rows.select("_row", key, *keep)
        .join(scores, "_row", "left")
        .select(key, F.coalesce("score", F.lit(0)).cast("long").alias("score"), *keep)
    )


def document_sentiment(
    df: DataFrame, lexicon: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(key, score, kept columns): positive minus negative hits per text, 0 for none.

    A lexicon of opinion words is small. Once a bounded read shows that it is, its words become
    a hash set inside the expression and every text is scored where it was read: no token rows,
    no join, no shuffle. A lexicon beyond the bound is joined to the exploded tokens instead, with
    the same result. A row of the lexicon that is repeated counts once, a word with several
    polarities counts with their sum; rows of equal keys are scored apart.
    """
    lexicon = materialize(
        lexicon.select("word", "polarity").filter(F.col("polarity") != 0).distinct(), "lexicon"
    )
    words = small_rows(lexicon)
    if words is not None and len({w.polarity for w in words}) <= 10:
        return _score_in_rows(df, words, key, text, keep)
    return _score_by_join(df, lexicon, key, text, keep)


def genre_sentiment(scored: DataFrame, genres: str = "genres", plain_mean: bool = False) -> DataFrame:
    """Total, record count and two-decimal mean score per genre.

    A genre repeated in one list counts once. Records are the films with a score other than 0
    unless ``plain_mean`` asks for all films; no record gives a NULL mean.
    """
    rows = scored.select(F.explode(F.array_distinct(genres)).alias("genre"), "score")
    counted = F.count(F.lit(1)) if plain_mean else F.count_if(F.col("score") != 0)
    totals = rows.groupBy("genre").agg(
        F.sum("score").cast("long").alias("total_score"), counted.cast("long").alias("n_records")
    )
    mean = F.try_divide(F.col("total_score").cast("double"), F.col("n_records").cast("double"))
    return totals.withColumn("mean_score", F.bround(mean, 2))
