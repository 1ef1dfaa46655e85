"""Session defaults and the two physical-plan helpers the operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Side tables are broadcast only after a count has shown that they fit, and become constants of
# an expression only if they are smaller still.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 << 20
CONSTANT_MAX_ROWS = 10_000


def build_session(app: str = "filmlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a temporary folder, which is
    removed when the program ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="filmlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/filmlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step", group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    A reader holds a row group at a time; ``group_rows`` bounds one where rows are large arrays.

    Used where several later passes read one expensive result: the lineage is cut, a lost
    executor costs no recomputation, and the reader knows the true size for its join choice.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    options = {} if group_rows is None else {"parquet.block.row.count.limit": group_rows}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_small(scan: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores, for work heavy in CPU per byte.

    Splits are cut by bytes, so a small file of long texts or documents is one task. A scan with
    at least one split per core, as any large input has, is returned as it is. Pass the bare
    scan: asking a plan with shuffles for its partitions would already run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def spread_rows(scan: DataFrame, rows: int) -> DataFrame:
    """Spread a scan so that a task has about so many rows, for work that makes much of each row.

    Splits are cut by bytes, so a task may get millions of narrow rows. A scan that is cut finely
    enough is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-scan.count() // rows))
    return scan.repartition(parts) if scan.rdd.getNumPartitions() < parts else scan


def _width(field: T.StructField) -> Column:
    """About the bytes of one value of a column."""
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.coalesce(8 * F.array_size(value), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 16
    return F.lit(8)


def broadcast_checked(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Hint a broadcast only if rows and bytes prove ``df`` small; else leave the shuffle join.

    The check stops at ``max_rows + 1`` rows. Pass a scan or a materialised table, not a heavy plan.
    """
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def small_rows(df: DataFrame, max_rows: int | None = None) -> list | None:
    """Rows of a small table, for use as constants of an expression; None if it is not small.

    The read stops at one row beyond the bound. Pass a scan or a materialised table.
    """
    bound = CONSTANT_MAX_ROWS if max_rows is None else max_rows
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None
