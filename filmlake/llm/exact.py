"""Exact deduplication as a stream with keyed state on disk, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.session import fresh_path, materialize

from .common import as_scan, locator, unused

# Fixed value: what counts as white space, one run of it being one space.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Files that one micro-batch takes from the landing folder.
FILES_PER_BATCH = 10_000


def normalised(text: str = "text") -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, doc_id: str, text: str, digest=sha256, *more: Column) -> DataFrame:
    """(doc_id, digest, locator) of each row of a scan of Parquet files, and more columns."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        digest(normalised(text)).alias("digest"),
        locator().alias("locator"),
        *more,
    )


class SeenTexts:
    """Every digest seen so far, with the stable identifier and locator of its first row.

    The state lives in RocksDB, its checkpoint below the shared folder, and never expires. Each
    call of ``ingest`` takes what was added to the landing folder since the last one, so a job can
    go on with a corpus that grows; a lost executor reads its part of the state back from the
    checkpoint. ``partitions`` of the state are fixed when it is made.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or fresh_path(spark, "seen")

    @property
    def landing(self) -> str:
        return f"{self.folder}/landing"

    def _session(self) -> SparkSession:
        """A session of its own, so that the caller's settings stay as they are."""
        session = self.spark.newSession()
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        # Without it RocksDB reserves several MB of disk for every partition of the state.
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
        session.conf.set(
            "spark.sql.shuffle.partitions", self.spark.conf.get("spark.sql.shuffle.partitions")
        )
        return session

    def land(self, entries: DataFrame) -> None:
        """Add the entries of a new batch to the landing folder."""
        entries.write.mode("append").parquet(self.landing)

    def ingest(self) -> None:
        """Take all that has landed into the state, in micro-batches of bounded size."""
        session = self._session()
        schema = self.spark.read.parquet(self.landing).schema
        (
            session.readStream.schema(schema)
            .option("maxFilesPerTrigger", FILES_PER_BATCH)
            .parquet(self.landing)
            .groupBy("digest")
            .agg(F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("rows"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", f"{self.folder}/state")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    def state(self) -> DataFrame:
        """(digest, keep_id, keep_locator, rows), written once from the state store itself."""
        stored = self._session().read.format("statestore").load(f"{self.folder}/state")
        columns = stored.select("key.digest", "value.*").toDF("digest", "first", "rows")
        path = fresh_path(self.spark, "state")
        columns.select(
            "digest",
            F.col("first.doc_id").alias("keep_id"),
            F.col("first.locator").alias("keep_locator"),
            "rows",
        ).write.parquet(path)
        return self.spark.read.parquet(path)


def first_of() -> Column:
    """Orders rows by identifier, null ones last, then by place."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "locator")


def collisions(docs: DataFrame, text: str, digest=sha256) -> DataFrame:
    """Digests that stand for more than one normalised text, by a comparison of all bytes.

    Copies are counted together in each task before anything is shuffled, so a large group costs
    one row per task; and no text is gathered with those of another digest in one place.
    """
    whole = normalised(text).alias("_whole")
    texts = docs.select(whole).groupBy("_whole").agg(F.count(F.lit(1)).alias("n"))
    return (
        texts.groupBy(digest(F.col("_whole")).alias("digest"))
        .agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1")
    )


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256
) -> DataFrame:
    """One row per row of ``docs``: doc_id, locator, keep_id, group_size, kept, digest.

    A frame that is not a scan of Parquet files is written as one first. Texts are equal when identical after each run of white
    space has become one space; null counts as empty. Of equal texts the row with the smallest
    doc_id stays, of rows that also share the doc_id the first by file and place, and null
    identifiers come last. So each group keeps exactly one row, repeated rows included. Other
    columns, whatever their names, are not read. An empty table gives an empty one.

    The digests go through ``SeenTexts``; its hits are then checked on their full bytes, and should
    two texts ever share a digest, their rows are grouped by the text itself.
    """
    docs = as_scan(docs)
    seen = SeenTexts(docs.sparkSession)
    seen.land(located(docs, doc_id, text, digest))
    seen.ingest()
    entries = docs.sparkSession.read.parquet(seen.landing)
    shared = materialize(collisions(docs, text, digest), "collisions")
    found = entries.join(seen.state(), "digest")
    if not shared.isEmpty():
        exact = _by_text(docs, doc_id, text, digest, shared)
        found = found.join(shared.select("digest"), "digest", "left_anti").unionByName(exact)
    return found.select(
        "doc_id",
        "locator",
        "keep_id",
        F.col("rows").alias("group_size"),
        (F.col("locator") == F.col("keep_locator")).alias("kept"),
        "digest",
    )


def _by_text(docs: DataFrame, doc_id: str, text: str, digest, shared: DataFrame) -> DataFrame:
    """Groups of the rows whose digests collide, by their whole normalised texts."""
    rows = located(docs, doc_id, text, digest, normalised(text).alias("_whole")).join(
        shared.select("digest"), "digest", "left_semi"
    )
    groups = rows.groupBy("_whole").agg(
        F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    return rows.join(groups, "_whole").select(
        "digest",
        "doc_id",
        "locator",
        F.col("first.doc_id").alias("keep_id"),
        F.col("first.locator").alias("keep_locator"),
        "rows",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``deduplicate`` keeps, with all their columns."""
    docs = as_scan(docs)
    place = unused(docs, "place")
    kept = deduplicate(docs, doc_id, text).filter("kept").select(F.col("locator").alias(place))
    placed = docs.select(locator().alias(place), *docs.columns)
    return placed.join(kept, place, "left_semi").select(*docs.columns)
