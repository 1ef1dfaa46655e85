"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.session import materialize

from .common import as_scan, located, locator, slices, unused
from .graph import components
from .shingles import WORDS, mixed, shingle_sets

SIMILARITY = 0.8
RECALL = 0.999
MOST_HASHES = 128
# N-grams of one side of a block of comparisons.
BLOCK_GRAMS = 300_000


def choose_bands(
    similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES
) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair at the threshold with this recall."""
    best = None
    for rows in range(1, most + 1):
        hit = similarity**rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall cannot be reached with so few hashes")
    return best


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of the MinHash signature of a set that is not empty."""
    keys = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64))
    least = np.full(len(keys), np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 1024):
        part = grams[at : at + 1024]
        permuted = (part[None, :] ^ keys[:, None]) * (keys[:, None] | np.uint64(1))
        least = np.minimum(least, permuted.min(axis=1))
    state = mixed(np.arange(bands, dtype=np.uint64))
    for row in least.reshape(bands, rows).T:
        state = mixed(state + mixed(row))
    return state


def sketches(docs: DataFrame, doc_id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """(locator, doc_id, digest of the n-gram set, number of n-grams, band hashes) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = part.column("_text").to_pylist()
                sets = shingle_sets(texts, words)
                digests = [
                    hashlib.md5(s.tobytes() if len(s) else b"text" + t.encode()).hexdigest()
                    for s, t in zip(sets, texts, strict=True)
                ]
                hashes = [
                    band_hashes(s, bands, rows).view(np.int64) if len(s) else [] for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("locator"),
                        part.column("doc_id"),
                        pa.array(digests),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(hashes, pa.list_(pa.int64())),
                    ],
                    ["locator", "doc_id", "digest", "grams", "bands"],
                )

    rows_of = located(docs, doc_id, text)
    kind = rows_of.schema["doc_id"].dataType.simpleString()
    return rows_of.mapInArrow(
        run,
        f"locator struct<file string, row long>, doc_id {kind}, digest string, grams long, "
        "bands array<long>",
    )


def compare(block: pa.Table, similarity: float, halves: bool) -> pa.Table:
    """(node, links, root): what each member of a block is linked to in it.

    ``side`` says from which half of the block a member comes; a block of two ``halves`` compares
    only members of different ones. ``links`` counts the rows that partners stand for, ``root``
    is the least node that links lead to. Each member's n-grams are marked once and counted over
    all others together, so a block of m members costs m passes over its n-grams and no pair is
    ever a row.
    """
    node = block.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    node = node[order]
    sets = [np.frombuffer(s, np.uint64) for s in block.column("set").to_pylist()]
    sets = [sets[i] for i in order]
    copies = block.column("copies").to_numpy()[order]
    side = block.column("side").to_numpy()[order]
    sizes = np.array([len(s) for s in sets])
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    links = np.zeros(len(node), np.int64)
    parent = np.arange(len(node))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    mark = np.zeros(len(distinct), np.int64)
    for i in range(len(node)):
        if halves and side[i] != side.min():
            continue
        own = flat[begins[i] : begins[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], begins)
        mark[own] = 0
        alike = both / (sizes + sizes[i] - both) >= similarity
        alike &= (side != side[i]) if halves else (np.arange(len(node)) != i)
        partners = np.flatnonzero(alike)
        links[i] += copies[partners].sum()
        if halves:
            links[partners] += copies[i]
        for j in partners:
            a, b = find(i), find(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = node[[find(i) for i in range(len(node))]]
    return pa.table({"node": node, "links": links, "root": roots})


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    recall: float = RECALL,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """One row per row of ``docs``: locator, doc_id, class_id, n_links, first.

    Two texts are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``similarity``; a class is what links connect. ``class_id`` is the smallest doc_id of the
    class, ``n_links`` the number of other rows linked to the row, ``first`` marks one row of
    each class: the smallest doc_id, null ones last, ties by file and place. A frame that is not a
    scan of Parquet files is written as one first. Null texts count as empty; texts without words are linked only to equal ones,
    those of fewer than ``words`` words have one n-gram. Other columns are not read.

    Rows with equal n-gram sets are counted together first and stand as one node from there on.
    Nodes that share a band hash are tied to the least one in that bucket; the connected groups
    that result hold every candidate pair, and inside a group all pairs are decided on the full
    n-gram sets, in blocks of at most 2 x ``block_grams`` n-grams for a group of any size.
    """
    docs = as_scan(docs)
    bands, rows = choose_bands(similarity, recall)
    seen = materialize(sketches(docs, doc_id, text, words, bands, rows), "sketches")
    nodes = materialize(
        seen.groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "locator")).alias("f"),
            F.count(F.lit(1)).alias("copies"),
            F.first("grams").alias("grams"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = (
        entries.groupBy("bucket")
        .agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    ties = entries.join(centres, "bucket").filter("node <> centre")
    groups = components(ties.select(F.col("centre").alias("a"), F.col("node").alias("b")))

    members = nodes.select("node", "copies", "grams", F.col("f.locator").alias("place")).join(
        groups, "node"
    )
    cuts = members.groupBy("root").agg(
        F.ceil(F.sum("grams") / F.lit(block_grams)).cast("int").alias("parts")
    )
    placed = members.join(cuts, "root").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    sets = _sets(docs, text, words, placed)
    blocks = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "root", "parts", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        F.col("part").alias("side"), "node", "copies", "set",
    )

    def run(key: tuple, block: pa.Table) -> pa.Table:
        found = compare(block, similarity, key[2].as_py() != key[3].as_py())
        return found.append_column("parts", pa.array([key[1].as_py()] * len(found), pa.int32()))

    found = materialize(
        blocks.groupBy("root", "parts", "low", "high").applyInArrow(
            run, "node long, links long, root long, parts int"
        ),
        "found",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    # A group in one block is settled; one cut into several is joined up over its blocks.
    wide = components(
        found.filter("parts > 1").select(F.col("node").alias("a"), F.col("root").alias("b"))
    ).withColumnRenamed("root", "far")
    settled = nodes.join(links, "node", "left").join(wide, "node", "left").select(
        "digest",
        "copies",
        "f",
        F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("far", "root", "node").alias("class"),
    )
    least = settled.groupBy("class").agg(F.min("f").alias("g"))
    labels = settled.join(least, "class").select("digest", "copies", "links", "g")
    return seen.join(labels, "digest").select(
        "locator",
        "doc_id",
        F.col("g.doc_id").alias("class_id"),
        (F.col("copies") - 1 + F.col("links")).alias("n_links"),
        (F.col("locator") == F.col("g.locator")).alias("first"),
    )


def _sets(docs: DataFrame, text: str, words: int, placed: DataFrame) -> DataFrame:
    """The members in ``placed`` with their full n-gram sets, taken from their texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                sets = shingle_sets(part.column("_text").to_pylist(), words)
                rest = [c for c in part.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.array([s.tobytes() for s in sets], pa.binary())],
                    [*rest, "set"],
                )

    texts = docs.select(locator().alias("_place"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    joined = texts.join(placed, F.col("_place") == F.col("place")).select(
        "root", "parts", "part", "node", "copies", "_text"
    )
    return joined.mapInArrow(
        run, "root long, parts int, part int, node long, copies long, set binary"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their class, with all their columns."""
    docs = as_scan(docs)
    place = unused(docs, "place")
    first = classes(docs, doc_id, text).filter("first").select(F.col("locator").alias(place))
    placed = docs.select(locator().alias(place), *docs.columns)
    return placed.join(first, place, "left_semi").select(*docs.columns)
