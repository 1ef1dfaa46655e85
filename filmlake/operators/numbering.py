"""Dense positions and neighbour look-ups over a total order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

_LOCAL_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str | Column], index: str = "row_idx") -> DataFrame:
    """0, 1, 2, ... in the given total order.

    A range sort lays the rows out in order; each row keeps its (partition, offset) position
    and the result is written once, so both later reads see the same layout. The only other
    table is one row count per sort partition; its running sum is the partition's first number.
    """
    placed = materialize(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered"
    )
    part = F.shiftright("_at", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per sort partition, so this window and this broadcast are small by construction
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(index, (F.col("_start") + local).cast("long"))
        .drop("_part", "_start", "_at")
    )


def with_neighbours(
    df: DataFrame, index: str, column: str, offsets: Sequence[int], block: int = 100_000
) -> DataFrame:
    """Add ``column`` of the rows at the given offsets of a dense index.

    Rows are cut into blocks of consecutive numbers; each block also receives the few rows
    just outside its edges, so the windows stay independent, bounded tasks.
    """
    reach = max(abs(o) for o in offsets)
    if block <= 2 * reach:
        raise ValueError("a block must be longer than the window around a row")
    own = F.floor(F.col(index) / F.lit(block)).cast("long")
    near = [F.floor((F.col(index) + F.lit(s)) / F.lit(block)).cast("long") for s in (-reach, reach)]
    spread = df.withColumn("_own", own).withColumn(
        "_block", F.explode(F.array_distinct(F.array(F.col("_own"), *near)))
    )
    w = W.partitionBy("_block").orderBy(index)
    looked = spread.select(
        "*",
        *[F.lead(column, o).over(w).alias(neighbour_name(column, o)) for o in offsets],
    )
    return looked.filter(F.col("_block") == F.col("_own")).drop("_block", "_own")


def neighbour_name(column: str, offset: int) -> str:
    """Column name a neighbour value gets: ``plot_m1`` is one row back, ``plot_p2`` two ahead."""
    return f"{column}_{'m' if offset < 0 else 'p'}{abs(offset)}"
