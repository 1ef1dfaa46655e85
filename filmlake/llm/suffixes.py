"""Repeated long byte strings, found with a family of sparse suffix arrays.

Only suffixes at anchors are indexed. The anchor of a string of ``LENGTH`` bytes is its k-byte
substring with the least hash (the leftmost of equal ones), so equal strings have equal anchors at
equal places, and a document has an anchor only every hundred bytes or so. A suffix is ordered by
the 64-bit hash of its first k bytes; suffixes that may share a long match therefore lie together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.session import materialize

from .common import as_scan, locator, partitions
from .shingles import mixed, rolling

LENGTH = 400
ANCHOR = 96
# Batches that a whole table is indexed in.
BATCHES = 4
# Suffixes with one anchor that a single task compares; more are compared by a shuffle.
MOST_TOGETHER = 20_000
# Strings of LENGTH that are hashed at once, and bytes of context that are judged at once.
SEGMENT, TOGETHER_BYTES = 4_000_000, 2_000_000
PLACE = np.uint64((1 << 24) - 1)


def anchors(raw: bytes, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(key, pos, low, high) of each anchor of a text.

    The anchor at ``pos`` is that of the strings that start ``low`` to ``high`` bytes before it.
    """
    found = [
        _segment(np.frombuffer(raw, np.uint8)[at : at + SEGMENT + length - 1], at, length, k)
        for at in range(0, max(0, len(raw) - length + 1), SEGMENT)
    ]
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _segment(data: np.ndarray, at: int, length: int, k: int) -> tuple[np.ndarray, ...]:
    sums, inverse = rolling(data)
    hashes = mixed((sums[k:] - sums[:-k]) * inverse[: len(data) - k + 1])
    ranked = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least(ranked, length - k + 1) & PLACE
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([first[1:], [len(least)]]) - 1
    pos = least[first].astype(np.int64)
    return hashes[pos].view(np.int64), pos + at, pos - last, pos - first


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, from running minima of blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


class SuffixFamily:
    """Levels of sorted suffixes; level sizes double, and a new batch is the smallest level.

    ``add`` writes a batch as a sorted array, scans it against itself and against every level, and
    then merges levels of equal size, as in binary counting. So each suffix is rewritten about
    log2(batches) times, and a batch is scanned against as many levels.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, []

    def _sorted(self, suffixes: DataFrame) -> DataFrame:
        spread = suffixes.repartition(partitions(self.spark), "key")
        return materialize(spread.sortWithinPartitions("key"), "suffixes")

    def add(self, batch: DataFrame) -> DataFrame:
        """Index (key, ...) and return the keys (key) that are now known to occur more than once."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, small), (_, large) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self._sorted(large.unionByName(small))))
        new = self._sorted(batch)
        keys = new.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        found = keys.filter("n > 1").select("key")
        for _, level in self.levels:
            found = found.union(
                keys.select("key").join(level.select("key"), "key", "left_semi")
            )
        self.levels.append((1, new))
        return materialize(found.distinct(), "repeated")

    def suffixes(self) -> DataFrame:
        """All that is indexed."""
        whole = self.levels[0][1]
        for _, level in self.levels[1:]:
            whole = whole.unionByName(level)
        return whole


def _profiles(docs: DataFrame, doc_id: str, text: str, length: int, k: int) -> DataFrame:
    """One row per row: place, doc_id, digest, n_bytes and the arrays of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode() for t in batch.column("_text").to_pylist()]
            made = [anchors(r, length, k) for r in raw]
            lists = [
                pa.array([m[c] for m in made], pa.list_(pa.int64())) for c in range(4)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("place"),
                    batch.column("doc_id"),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.array([len(r) for r in raw], pa.int64()),
                    *lists,
                ],
                ["place", "doc_id", "digest", "n_bytes", "key", "pos", "low", "high"],
            )

    rows = docs.select(
        locator().alias("place"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"place struct<file string, row long>, doc_id {kind}, digest string, n_bytes long, "
        "key array<long>, pos array<long>, low array<long>, high array<long>",
    )


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(key, node, start, context): all bytes of the strings that each anchor stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                starts = [a["pos"] - a["high"] for a in found]
                cut = [
                    raw[s : a["pos"] - a["low"] + length]
                    for s, a in zip(starts, found, strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([a["key"] for a in found], pa.int64()),
                        "node": pa.array([node] * len(found), pa.int64()),
                        "start": pa.array(starts, pa.int64()),
                        "context": pa.array(cut, pa.binary()),
                    }
                )

    return texts.select("node", "text", "found").mapInArrow(
        run, "key long, node long, start long, context binary"
    )


def string_hashes(
    keys: np.ndarray, contexts: list[bytes], length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of context) of every string of ``length`` bytes inside the contexts, in order."""
    hashes, owners = [], []
    at = 0
    while at < len(contexts):
        end, size = at, 0
        while end < len(contexts) and (end == at or size + len(contexts[end]) <= 500_000):
            size += len(contexts[end])
            end += 1
        sizes = np.array([len(c) for c in contexts[at:end]])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        owner = np.repeat(np.arange(at, end), counts)
        starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts += np.repeat(begins, counts)
        sums, inverse = rolling(np.frombuffer(b"".join(contexts[at:end]), np.uint8))
        own = mixed((sums[starts + length] - sums[starts]) * inverse[starts])
        hashes.append(mixed(own + keys[owner].view(np.uint64)))
        owners.append(owner)
        at = end
    empty = np.empty(0, np.uint64), np.empty(0, np.int64)
    return (np.concatenate([empty[0], *hashes]), np.concatenate([empty[1], *owners]))


def _runs(table: pa.Table, length: int) -> pa.RecordBatch:
    """(node, begin, end) of the bytes covered by strings that occur twice among whole groups."""
    keys = table.column("key").to_numpy()
    nodes, origin = table.column("node").to_numpy(), table.column("start").to_numpy()
    hashes, owner = string_hashes(keys, table.column("context").to_pylist(), length)
    _, kind, times = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = times[kind] > 1
    fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
    opens = np.flatnonzero(twice & (fresh | ~np.concatenate([[False], twice[:-1]])))
    closes = np.flatnonzero(
        twice & (np.concatenate([fresh[1:], [True]]) | ~np.concatenate([twice[1:], [False]]))
    )
    first = np.searchsorted(owner, owner[opens])
    begin = origin[owner[opens]] + opens - first
    end = origin[owner[opens]] + closes - first + length
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[owner[opens]]), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
        ["node", "begin", "end"],
    )


def _judged_together(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of groups that fit a task: sorted by key, and judged several groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                held.append(part)
                size += part.nbytes
                if size < TOGETHER_BYTES:
                    continue
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))
                if whole:
                    yield _runs(table.slice(0, whole), length)
                    # What is left of the last group is copied, so that the rest can go.
                    held = table.slice(whole).combine_chunks().to_batches()
                    size = sum(len(c) for c in table.column("context").slice(whole).to_pylist())
        if held:
            yield _runs(pa.Table.from_batches(held), length)

    spread = contexts.repartition(partitions(contexts.sparkSession), "key").sortWithinPartitions("key")
    return spread.mapInArrow(run, "node long, begin long, end long")


def _judged_apart(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of groups too large for a task: their strings are counted by a shuffle instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = part.column("key").to_numpy()
                hashes, owner = string_hashes(keys, part.column("context").to_pylist(), length)
                first = np.searchsorted(owner, owner)
                begin = part.column("start").to_numpy()[owner] + np.arange(len(owner)) - first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array(part.column("node").to_numpy()[owner]),
                        pa.array(begin, pa.int64()),
                    ],
                    ["hash", "node", "begin"],
                )

    strings = contexts.mapInArrow(run, "hash long, node long, begin long")
    twice = strings.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return strings.join(twice, "hash").select(
        "node", "begin", (F.col("begin") + length).alias("end")
    )


def repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    k: int = ANCHOR,
    batches: int = BATCHES,
    most_together: int = MOST_TOGETHER,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans, n_removed, kept_sha256.

    ``spans`` (array of begin, end; in bytes of UTF-8) are the maximal runs of bytes that are
    covered by a string of ``length`` bytes which also starts anywhere else, in the same text or
    another; overlapping strings count, strings never cross texts, and all are judged on the input.
    ``kept_sha256`` is the digest of the bytes outside the spans. Null counts as empty; texts
    shorter than ``length`` have no spans. Repeated rows repeat each other's texts. Other columns
    are not read, and an empty table gives an empty one.

    Of equal texts one is indexed, as all their bytes are repeated anyway. The others go into a
    ``SuffixFamily`` in ``batches`` parts; suffixes whose anchors occur again are compared
    on all the bytes their anchors stand for, and only texts that hold such suffixes are
    read again. A group of up to ``most_together`` suffixes is compared in one task, a larger one by
    counting its strings with a shuffle, with the same result.
    """
    docs = as_scan(docs)
    profiles = materialize(
        _profiles(docs, doc_id, text, length, k).withColumn("node", F.monotonically_increasing_id()),
        "profiles",
    )
    groups = materialize(
        profiles.groupBy("digest").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies")),
        "texts",
    )
    entries = (
        profiles.select("node", F.arrays_zip("key", "pos", "low", "high").alias("found"))
        .filter(F.size("found") > 0)
        .join(groups.select("node"), "node", "left_semi")
        .select("node", F.inline("found"))
    )
    part = F.pmod(F.xxhash64("node"), F.lit(batches))
    family = SuffixFamily(docs.sparkSession)
    repeated = None
    for number in range(batches):
        found = family.add(entries.filter(part == number))
        repeated = found if repeated is None else repeated.unionByName(found)
    hits = family.suffixes().join(repeated.distinct(), "key", "left_semi")
    per_text = hits.groupBy("node").agg(
        F.collect_list(F.struct("key", "pos", "low", "high")).alias("found")
    )
    places = profiles.select("node", "place").join(per_text, "node")
    texts = materialize(
        docs.select(locator().alias("place"), F.col(text).alias("text")).join(places, "place"),
        "texts",
    )
    contexts = materialize(_contexts(texts, length), "contexts")
    crowded = (
        contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_together)
    )
    large = materialize(crowded.select("key"), "crowded")
    if large.isEmpty():
        runs = _judged_together(contexts, length)
    else:
        runs = _judged_together(contexts.join(large, "key", "left_anti"), length).unionByName(
            _judged_apart(contexts.join(large, "key", "left_semi"), length)
        )
    spans = runs.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("runs"))
    cut = _cut(texts.select("node", "text").join(spans, "node"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return (
        profiles.select("node", "doc_id", "digest", "n_bytes")
        .join(groups.select("digest", "copies"), "digest")
        .join(cut, "node", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(copied, whole)
            .otherwise(F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")))
            .alias("spans"),
            F.when(copied, F.sha2(F.lit("").cast("binary"), 256))
            .otherwise(F.coalesce("kept", "digest"))
            .alias("kept_sha256"),
        )
        .withColumn(
            "n_removed",
            F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]),
        )
    )


def _cut(texts: DataFrame) -> DataFrame:
    """(node, spans, kept): the runs joined up, and the digest of the bytes outside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, spans, kept = [], [], []
            for node, text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, joined, digest, at = text.encode(), [], hashlib.sha256(), 0
                for run_ in runs:
                    if joined and run_["begin"] <= joined[-1]["end"]:
                        joined[-1]["end"] = max(joined[-1]["end"], run_["end"])
                    else:
                        joined.append(dict(run_))
                for span in joined:
                    digest.update(raw[at : span["begin"]])
                    at = span["end"]
                digest.update(raw[at:])
                nodes.append(node)
                spans.append(joined)
                kept.append(digest.hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(nodes, pa.int64()),
                    "spans": pa.array(
                        spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                    ),
                    "kept": pa.array(kept, pa.string()),
                }
            )

    return texts.select("node", "text", "runs").mapInArrow(
        run, "node long, spans array<struct<begin:bigint,end:bigint>>, kept string"
    )
