"""Scores of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import neighbour_name, with_neighbours

SIBLING_OFFSETS = (-2, -1, 1, 2)


def tolerance_accuracy(df: DataFrame, truth: str, prediction: str, tolerance: float) -> DataFrame:
    """Share of rows whose absolute error is at most ``tolerance``.

    A missing prediction, or a missing truth, is wrong.
    """
    close = F.coalesce(F.abs(F.col(truth) - F.col(prediction)) <= F.lit(tolerance), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(close.cast("double")).alias("accuracy"))


def exact_accuracy(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Share of rows predicted exactly (A19); a missing prediction or truth is wrong."""
    right = F.coalesce(F.col(truth) == F.col(prediction), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"))


def micro_f1(df: DataFrame, truth: str = "y", prediction: str = "p") -> DataFrame:
    """Micro-averaged F1 over a long (row, label, y, p) table of 0/1 values."""
    y, p = F.col(truth) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )
    twice = 2.0 * F.col("tp")
    return counts.withColumn("f1", F.try_divide(twice, twice + F.col("fp") + F.col("fn")))


def micro_f1_sets(df: DataFrame, truth: str = "truth", prediction: str = "p") -> DataFrame:
    """Micro-averaged F1 of rows that hold their true and predicted labels as sets.

    The counts come from the labels that are there; the zeros of all other labels are never built. A
    missing list has no labels.
    """
    none = F.array().cast(df.schema[truth].dataType)
    t, p = (F.array_distinct(F.coalesce(c, none)) for c in (truth, prediction))
    both = F.size(F.array_intersect(t, p)).cast("long")
    sums = df.agg(
        F.coalesce(F.sum(both), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.size(p) - both), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.size(t) - both), F.lit(0)).alias("fn"),
    )
    twice = 2.0 * F.col("tp")
    return sums.withColumn("f1", F.try_divide(twice, twice + F.col("fp") + F.col("fn")))


def sibling_accuracy(
    tested: DataFrame, all_rows: DataFrame, key: str, truth: str = "genres_number",
    prediction: str = "prediction",
) -> DataFrame:
    """Share of tested rows whose prediction is any genre of the same film (A22, general form).

    Matched on (film, genre), so no genre set is collected per film.
    """
    known = all_rows.select(key, F.col(truth).alias(prediction), F.lit(1).alias("_hit")).distinct()
    return tested.join(known, [key, prediction], "left").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("accuracy")
    )


def neighbour_accuracy(
    rows: DataFrame, index: str, plot: str, truth: str = "genres_number",
    prediction: str = "prediction", block: int = 100_000,
) -> DataFrame:
    """Positional form (A22, W02): a prediction may match its row, or any row at most two
    positions away that has the same plot. Rows without a prediction are context only.

    Plots are only compared for equality; pass their :func:`fingerprint` so that no text moves.
    """
    me = F.struct(F.col(plot).alias("plot"), F.col(truth).alias("truth"))
    narrow = rows.select(index, prediction, me.alias("me"))
    near = with_neighbours(narrow, index, "me", SIBLING_OFFSETS, block)

    def matches(other):
        return F.coalesce(
            (other["plot"] == F.col("me.plot")) & (other["truth"] == F.col(prediction)), F.lit(False)
        )

    right = F.coalesce(F.col("me.truth") == F.col(prediction), F.lit(False))
    for o in SIBLING_OFFSETS:
        right = right | matches(F.col(neighbour_name("me", o)))
    return near.filter(F.col(prediction).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy")
    )
