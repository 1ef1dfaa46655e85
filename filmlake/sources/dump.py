"""Line-oriented JSON entity dumps: scan, clean, re-shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a dump, plain or gzip, one file or a folder of shards.

    A gzip file is one task, so a big dump should first go through :func:`reshard_dump`.
    """
    return spark.read.text(path)


def entity_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Drop the array bracket lines and the separator comma that ends a line."""
    value = F.col(column)
    return lines.filter(F.length(value) > 1).withColumn(column, F.regexp_replace(value, ",$", ""))


def reshard_dump(
    lines: DataFrame,
    path: str,
    *,
    partitions: int | None = None,
    target_bytes: int | None = None,
    max_records: int | None = None,
) -> None:
    """Write the lines as many gzip text files so that later scans run in parallel.

    ``partitions`` spreads the lines round-robin over that many files; ``target_bytes`` takes so
    many files that each holds about that much text, as a pass over the lengths of the lines
    shows; ``max_records`` bounds the lines per file.
    """
    if target_bytes:
        size = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
        partitions = max(1, -(-size // target_bytes))
    out = lines.repartition(partitions) if partitions else lines
    writer = out.write.mode("overwrite").option("compression", "gzip")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.text(path)
