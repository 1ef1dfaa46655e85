"""Lists filtered to a set of elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize, small_rows


def keep_elements(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """``df`` with each list cut to the elements in ``allowed`` (one column), order and repeats kept.

    A NULL list stays NULL, a list without allowed elements becomes empty, and no row is lost.
    ``allowed`` is a written table. A small one, as a bounded read shows, filters every list in
    place. A larger one meets the entries in a semi join, broadcast if checked small, else
    shuffled, where AQE splits an element that dominates; the lists are put together again by a
    number given to each row, so rows with equal keys stay apart. Both ways give the same rows.
    """
    known = small_rows(allowed)
    if known is not None:
        listed = [row[0] for row in known]
        kept = F.filter(column, lambda e: e.isin(listed) if listed else F.lit(False))
        return df.withColumn(column, kept)
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    entries = rows.select("_row", F.posexplode(column).alias("_pos", "_elem"))
    matched = entries.join(broadcast_checked(allowed.toDF("_elem")), "_elem", "left_semi")
    lists = matched.groupBy("_row").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_pos", "_elem"))), lambda s: s["_elem"]
        ).alias("_kept")
    )
    empty = F.array().cast(df.schema[column].dataType)
    kept = F.when(F.col(column).isNotNull(), F.coalesce("_kept", empty))
    return rows.join(lists, "_row", "left").withColumn(column, kept).select(*df.columns)
