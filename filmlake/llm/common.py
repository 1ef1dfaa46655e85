"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.session import materialize

# Batches are cut to pieces of this many characters before their texts are worked on together.
WORK_CHARS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = WORK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the characters of one column, so that arrays made from it stay small."""
    begin, size = 0, 0
    for row, length in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        size += length
        if size >= most:
            yield batch.slice(begin, row + 1 - begin)
            begin, size = row + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def locator() -> Column:
    """Where a row's content lies: its file and its place in it; for scans of Parquet files."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def located(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(locator, doc_id, _text) of each row of a scan of Parquet files."""
    return docs.select(
        locator().alias("locator"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``docs`` is called that."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def as_scan(docs: DataFrame) -> DataFrame:
    """``docs`` itself if its rows have locators, else a written copy whose rows have them."""
    try:
        docs.select(locator()).schema  # noqa: B018
    except AnalysisException:
        return materialize(docs, "rows")
    return docs
