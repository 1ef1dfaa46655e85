"""Table overview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count and row count.

    All counts come from one aggregation; NaN counts as missing.
    """
    floating = {n for n, t in df.dtypes if t in ("double", "float")}

    def present(name: str):
        col = F.col(f"`{name}`")
        return F.count(F.when(~F.isnan(col), col) if name in floating else col)

    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[present(n).alias(f"n{i}") for i, n in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(n).alias("column_name"),
            F.lit(t).alias("data_type"),
            F.col(f"n{i}").alias("non_null"),
            F.col("n_rows"),
        )
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value per column, in one pass."""
    pairs = df.agg(
        *[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return pairs.select(F.inline(F.array(*entries)))
