"""Removal of rare list elements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .elements import keep_elements


def element_counts(df: DataFrame, column: str, per_row: bool = False) -> DataFrame:
    """(elem, n): occurrences over the whole column, or rows that hold the element."""
    items = F.array_distinct(column) if per_row else F.col(column)
    return df.select(F.explode(items).alias("elem")).groupBy("elem").agg(
        F.count(F.lit(1)).alias("n")
    )


def _keep_common(df: DataFrame, column: str, least: int, per_row: bool) -> DataFrame:
    counts = element_counts(df, column, per_row)
    common = materialize(counts.filter(F.col("n") > least).select("elem"), "common")
    return keep_elements(df, column, common)


def remove_rare(df: DataFrame, columns: Sequence[str], least: int = 1) -> DataFrame:
    """Delete list elements seen at most ``least`` times; drop rows left empty.

    ``df`` is read twice, so pass a scan or a written table. Columns go in sequence, and each pass counts on the rows the one before it kept, so the
    order matters. Counting is a partial aggregation, and the common elements are written once.
    """
    for i, column in enumerate(columns):
        df = drop_empty_lists(_keep_common(df, column, least, per_row=False), column)
        if i + 1 < len(columns):
            df = materialize(df, "rare-pass")
    return df


def remove_rare_by_rows(df: DataFrame, column: str, least: int = 1) -> DataFrame:
    """The variant that counts rows instead of occurrences and keeps emptied rows."""
    return _keep_common(df, column, least, per_row=True)


def drop_empty_lists(df: DataFrame, column: str) -> DataFrame:
    """Rows whose list still has an element."""
    return df.filter(F.size(column) > 0)
