"""Genre lists: counts, shares, support filter, explosion and indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_checked
from .elements import keep_elements
from .numbering import number_rows


def genre_rows(df: DataFrame, key: str = "film", genres: str = "genres", keep=()) -> DataFrame:
    """One row per list entry: (key, pos, genre, kept columns).

    This long table is the grouped form: rows are grouped by the ``genre`` column, never by
    collecting all texts of a genre into one value. Take the text along only if needed.
    """
    return df.select(key, F.posexplode(genres).alias("pos", "genre"), *keep)


def genre_counts(df: DataFrame, genres: str = "genres") -> DataFrame:
    """Entries per genre (A04); partial counts leave each task, not rows."""
    return df.select(F.explode(genres).alias("genre")).groupBy("genre").agg(
        F.count(F.lit(1)).alias("n")
    )


def frequent_genres(df: DataFrame, least: int, genres: str = "genres") -> DataFrame:
    """Genres with at least ``least`` entries."""
    return genre_counts(df, genres).filter(F.col("n") >= least)


def genre_shares(counts: DataFrame) -> DataFrame:
    """Share of the total over the genres given (A05, W03); the total is a scalar subquery."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def keep_genres(df: DataFrame, allowed: DataFrame, genres: str = "genres") -> DataFrame:
    """Keep the allowed genres of each list in order; drop films left with none.

    ``allowed`` may be read twice, so pass a written table such as :func:`genre_vocabulary`.
    """
    return keep_elements(df, genres, allowed.select("genre")).filter(F.size(genres) > 0)


def first_place(rows: DataFrame, key: str, pos: str) -> Column:
    """Smallest (key, pos). A whole-number key is packed with the position into one number, which
    a hash aggregate can hold; a struct would sort every occurrence before the partial step."""
    if isinstance(rows.schema[key].dataType, T.IntegralType):
        packed = F.col(key).cast("decimal(20,0)") * F.lit(1 << 32) + F.col(pos)
        return F.min(packed.cast("decimal(38,0)"))
    return F.min(F.struct(key, pos))


def first_seen(
    rows: DataFrame, value: str, key: str, pos: str = "pos", index: str = "idx"
) -> DataFrame:
    """Distinct values numbered 0, 1, ... by first appearance.

    ``rows`` holds one row per occurrence, read in the order of ``key`` and ``pos``. The first
    place of each value is a partial aggregation; only the vocabulary is sorted.
    """
    first = rows.groupBy(value).agg(first_place(rows, key, pos).alias("_first"))
    return number_rows(first, ["_first"], index).select(value, index)


def genre_vocabulary(
    df: DataFrame, least: int, key: str = "film", genres: str = "genres"
) -> DataFrame:
    """(genre, n, idx) of the frequent genres, numbered by first appearance.

    Support and first position come from one partial aggregation; the result is small and is
    written once, because filters, explosions and label columns all read it.
    """
    rows = genre_rows(df, key, genres)
    counted = (
        rows.groupBy("genre")
        .agg(F.count(F.lit(1)).alias("n"), first_place(rows, key, "pos").alias("_first"))
        .filter(F.col("n") >= least)
    )
    return number_rows(counted, ["_first"], "idx").select("genre", "n", "idx")


def predict_rows(
    df: DataFrame, vocabulary: DataFrame, key: str = "film", genres: str = "genres", keep=()
) -> DataFrame:
    """One numbered row per (film, genre): (row_idx, key, genres_number, kept columns)."""
    rows = genre_rows(df, key, genres, keep)
    indexed = rows.join(
        broadcast_checked(vocabulary.select("genre", F.col("idx").alias("genres_number"))), "genre"
    )
    return number_rows(indexed, [key, "pos"]).select(
        "row_idx", key, F.col("genres_number").cast("int").alias("genres_number"), *keep
    )


def genre_list(df: DataFrame) -> list[str]:
    """Genre names, sorted, as plan-time constants for one-column-per-genre layouts.

    The caller passes a support-filtered vocabulary. More names than a table can have columns
    for is refused rather than cut.
    """
    if not isinstance(df.schema["genre"].dataType, T.StringType):
        raise TypeError("genre must be text")
    names = [r.genre for r in df.select("genre").distinct().limit(2001).collect()]
    if len(names) > 2000:
        raise ValueError("too many genres for one column each; use the long form")
    return sorted(names)
