"""Multi-hot encoding of list columns in long, sparse form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked
from .genres import first_place
from .numbering import number_rows


def _entries(columns: Sequence[str], distinct: bool) -> Column:
    """All list entries of a row as (block number, block, pos, term)."""

    def block(number: int, name: str) -> Column:
        items = F.array_distinct(name) if distinct else F.col(name)
        cells = F.transform(
            items,
            lambda term, pos: F.struct(
                F.lit(number).alias("number"), F.lit(name).alias("block"), pos.alias("pos"),
                term.cast("string").alias("term"),
            ),
        )
        return F.coalesce(cells, F.array())

    return F.concat(*[block(i, c) for i, c in enumerate(columns)])


def concat_features(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Multi-hot blocks of several list columns side by side: (key, block, term, feature)
    (M01, M05, J07).

    Features are numbered block by block, within a block in first-seen order. One scan finds the
    first place of every (block, term), one sort of that vocabulary numbers them all. Absent
    pairs of the dense matrix are absent rows, and leaving a block out is a call with fewer
    columns.
    """
    rows = df.select(key, F.inline(_entries(columns, distinct=False)))
    first = rows.groupBy("number", "block", "term").agg(first_place(rows, key, "pos").alias("_first"))
    vocabulary = number_rows(first, ["number", "_first"], "feature").select("block", "term", "feature")
    cells = df.select(key, F.inline(_entries(columns, distinct=True))).select(key, "block", "term")
    return cells.join(broadcast_checked(vocabulary), ["block", "term"]).select(
        key, "block", "term", "feature"
    )


def multi_hot(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, term, idx) for each distinct element of each list; idx in first-seen order."""
    cells = concat_features(df, key, [column])
    return cells.select(key, "term", F.col("feature").alias("idx"))
