"""Joins of films, ratings and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATED_THRESHOLD = 40


def join_ratings(films: DataFrame, ratings: DataFrame) -> DataFrame:
    """Films with their ratings row; a column both sides own gets the suffixes _x and _y.

    Null keys never match. No hint: AQE turns the join into a broadcast or splits skewed keys
    by the sizes it measures.
    """
    key = "rotten_tomatoes_id"
    shared = (set(films.columns) & set(ratings.columns)) - {key}

    def marked(df, mark):
        return df.select(
            *[F.col(c).alias(c + mark) if c in shared else F.col(c) for c in df.columns]
        )

    return marked(films, "_x").join(marked(ratings, "_y"), key)


def join_chain(films: DataFrame, ratings: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Films x ratings x enrichment, the last on the films' own id."""
    joined = join_ratings(films, ratings)
    film_key = "imdb_id_x" if "imdb_id_x" in joined.columns else "imdb_id"
    if film_key == "imdb_id":
        return joined.join(enrichment, "imdb_id")
    return joined.join(enrichment, joined[film_key] == enrichment["imdb_id"])


def well_rated(df: DataFrame, least: int = RATED_THRESHOLD) -> DataFrame:
    """Films with enough audience ratings."""
    return df.filter(F.col("audience_ratings") >= least)


def complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in the given columns, or in any column."""
    return df.dropna("any", subset=list(columns) if columns else None)
