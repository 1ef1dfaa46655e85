"""Threshold-scaled sketches: every shingle hash below a fixed share of the hash range is kept, of every text."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, slices
from .shingles import WORDS, shingle_sets

# One hash in so many is kept, of short and long documents alike.
SCALE = 2
# Bytes of a kept hash in a fingerprint.
HASH_BYTES = 6
# Rows of a range of identifiers that are put in order together, and the most ranges.
RANGE_ROWS = 10_000
MOST_RANGES = 20_000


def _written(count: int, check: str, kept: np.ndarray, scale: int) -> str:
    """The fingerprint of the 64-bit ``kept``, all hashes of a set below 2 ** 64 / scale, in order."""
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
    return f"{count}:{check}:{scale}:{base64.b64encode(raw).decode()}"


def fingerprint(shingles: np.ndarray, scale: int = SCALE) -> str:
    """``<shingles>:<check>:<scale>:<kept hashes>`` of a set of 64-bit shingle hashes.

    The kept hashes are those below 2 ** 64 / scale, in order, base64 of ``HASH_BYTES`` bytes each.
    The check is a digest of the whole set, by which sets that kept the same hashes are still told
    apart.
    """
    kept = shingles if scale == 1 else shingles[shingles < np.uint64((1 << 64) // scale)]
    return _written(len(shingles), hashlib.md5(shingles.tobytes()).hexdigest()[:12], kept, scale)


def share_of(print_: str) -> int:
    """One hash in so many is kept in a fingerprint."""
    return int(print_.split(":")[2])


def kept_hashes(print_: str) -> np.ndarray:
    """The kept hashes of a fingerprint, sorted."""
    raw = np.frombuffer(base64.b64decode(print_.rsplit(":", 1)[1]), np.uint8)
    wide = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    wide[:, 8 - HASH_BYTES :] = raw.reshape(-1, HASH_BYTES)
    return np.unique(wide.view(">u8").ravel().astype(np.uint64))


def _alike(left: str, right: str) -> tuple[np.ndarray, np.ndarray, int]:
    """The hashes of both that the fingerprint with the larger scale would keep, and that scale."""
    share = max(share_of(left), share_of(right))
    limit = np.uint64((1 << 8 * HASH_BYTES) // share)
    a, b = kept_hashes(left), kept_hashes(right)
    return a[a < limit], b[b < limit], share


def merged(left: str, right: str) -> str:
    """The fingerprint of both documents' shingles together.

    The kept hashes are exactly those of the union; its number of shingles is estimated from them,
    and the check is made from both. Fingerprints of two scales give one of the larger.
    """
    if left.rsplit(":", 1)[0] == right.rsplit(":", 1)[0]:
        return left
    a, b, share = _alike(left, right)
    kept = np.union1d(a, b)
    check = hashlib.md5("|".join(sorted((left, right))).encode()).hexdigest()[:12]
    return _written(len(kept) * share, check, kept << np.uint64(64 - 8 * HASH_BYTES), share)


def likeness(left: str, right: str) -> float:
    """The estimated Jaccard similarity of two documents: 1 for equal sets."""
    if left == right:
        return 1.0
    a, b, _ = _alike(left, right)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 0.0


def containment(left: str, right: str) -> float:
    """The estimated share of the left document's shingles that the right one holds."""
    if left == right:
        return 1.0
    a, b, _ = _alike(left, right)
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def edited(text: str, next_text: str) -> str:
    """The last third of ``text`` replaced by as much (or all) of the start of ``next_text``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + next_text[:cut]


def _position(docs: DataFrame, doc_id: str) -> Column:
    """A number that never falls where identifiers rise; of text the first six bytes make it."""
    if not isinstance(docs.schema[doc_id].dataType, T.StringType):
        return F.col(doc_id).cast("double")
    start = F.rpad(F.hex(F.substring(F.encode(F.col(doc_id), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(start, 16, 10).cast("double")


def in_reading_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, bucket, guest), so laid out that each row's successor follows it in its task.

    The order is descending doc_id, null ones last, equal ones by text; after the last comes the
    first. Ranges of doc_id are the buckets: as many as shuffle partitions, or more so that each
    holds about ``RANGE_ROWS``; rows with one and the same identifier stay together. The first row
    of each is also sent, as a guest, to the bucket before it. Only the limits of the ranges, at most
    ``MOST_RANGES``, and their largest identifiers reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(_position(docs, doc_id), F.lit(-1e300)).alias("_at"),
    )
    ids = rows.select("_at", "doc_id")
    parts = max(partitions(spark), min(MOST_RANGES, -(-ids.count() // RANGE_ROWS)))
    steps = [k / parts for k in range(1, parts)]
    limits = sorted(set(ids.approxQuantile("_at", steps, 0.1 / parts))) if steps else []
    splits = [float("-inf"), *limits, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    ranges = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket")
    heads = sorted(
        ranges.transform(ids).groupBy("_bucket").agg(F.max("doc_id").alias("head")).collect()
    )
    kind = rows.schema["doc_id"].dataType
    hosts = spark.createDataFrame(
        # The bucket before, in descending order, is the next larger one; before the largest comes
        # the smallest.
        [(b, h, heads[(k + 1) % len(heads)][0]) for k, (b, h) in enumerate(heads)],
        T.StructType(
            [
                T.StructField("_bucket", T.DoubleType()),
                T.StructField("_head", kind),
                T.StructField("_host", T.DoubleType()),
            ]
        ),
    )
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest"))
    away = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    is_head = F.col("doc_id").eqNullSafe(F.col("_head"))
    return (
        ranges.transform(rows)
        .join(F.broadcast(hosts), "_bucket")  # at most one row a range
        .select("doc_id", "text", F.explode(F.when(is_head, F.array(own, away)).otherwise(F.array(own))).alias("_p"))
        .select("doc_id", "text", "_p.bucket", "_p.guest")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")
    )


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document.

    One row per row of ``docs``: doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (``likeness``), and in_edited, in_next
    (``containment``). The next document is the one with the next smaller doc_id, null ones last,
    equal ones by text, and after the last the first; a single document is followed by itself.
    Null texts count as empty: no shingle, likeness 1 to other texts without words and else 0.
    Other columns are not read, and an empty table gives an empty one.
    """
    ordered = in_reading_order(docs, doc_id, text)
    columns = [
        ("n_chars", T.LongType()),
        ("edited_sha256", T.StringType()),
        ("fingerprint", T.StringType()),
        ("edited_fingerprint", T.StringType()),
        ("near_edited", T.DoubleType()),
        ("near_next", T.DoubleType()),
        ("in_edited", T.DoubleType()),
        ("in_next", T.DoubleType()),
    ]
    kind = ordered.schema["doc_id"]

    def judged(rows: pa.Table) -> pa.RecordBatch:
        bucket, guest, texts = (rows.column(c).to_pylist() for c in ("bucket", "guest", "text"))
        pairs = [
            k for k in range(len(texts) - 1) if not guest[k] and bucket[k] == bucket[k + 1]
        ]
        changed = [edited(texts[k], texts[k + 1]) for k in pairs]
        prints = [fingerprint(s) for s in shingle_sets(texts + changed, WORDS)]
        found = []
        for n, (k, after) in enumerate(zip(pairs, changed, strict=True)):
            mine, other, following = prints[k], prints[len(texts) + n], prints[k + 1]
            digest = hashlib.sha256(after.encode()).hexdigest()
            found.append(
                (len(texts[k]), digest, mine, other, likeness(mine, other), likeness(mine, following),
                 containment(mine, other), containment(mine, following))
            )
        ids = rows.column("doc_id").combine_chunks().take(pa.array(pairs, pa.int64()))
        cells = list(zip(*found, strict=True)) or [[] for _ in columns]
        types = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}
        arrays = [pa.array(c, types[t]) for c, (_, t) in zip(cells, columns, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *(c for c, _ in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row so far, whose successor is still to come
        for batch in batches:
            for part in slices(batch):
                table = pa.Table.from_batches([part] if waiting is None else [waiting, part])
                yield judged(table)
                waiting = part.slice(part.num_rows - 1)

    schema = T.StructType([kind] + [T.StructField(c, t) for c, t in columns])
    return ordered.mapInArrow(run, schema)
