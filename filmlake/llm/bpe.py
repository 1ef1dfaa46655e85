"""Byte-level BPE: overlapping chunks, stitched where their pre-tokens fall into step again."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

CHUNK = 32_768
OVERLAP = 1_024


def _encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def certain_boundaries(body: str, pattern: str, low: int, high: int) -> list[int]:
    """Pre-token boundaries in [low, high) that hold wherever the pre-tokeniser began.

    A pre-token ends for certain where a character other than white space is followed by white
    space, a letter by something that is neither letter nor white space, or a number by a
    character of another kind. Other boundaries depend on what stands before the chunk.
    """
    found = []
    for match in regex.finditer(pattern, body):
        at = match.end()
        if at >= high or at >= len(body):
            break
        if at < low or at == 0:
            continue
        kinds = [_kind(body[at - 1]), _kind(body[at])]
        if kinds[0] != kinds[1] and (kinds[1] == "s" or kinds[0] in "ln") and kinds[0] != "s":
            found.append(at)
    return found


def _kind(char: str) -> str:
    if regex.match(r"\s", char):
        return "s"
    if regex.match(r"\p{L}", char):
        return "l"
    return "n" if regex.match(r"\p{N}", char) else "o"


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) of every row, as tiktoken encodes the text.

    A text of at most ``chunk`` code points is one chunk and is encoded where it lies. A longer
    one is cut into chunks that overlap; they are pre-tokenised in parallel, each pair of
    neighbours is cut at the first certain boundary that both see in their overlap, and the
    pieces between the cuts are encoded in parallel and put in order. Neighbours without such a
    boundary (one run of one kind, longer than the overlap) form one piece, so the ids are those
    of the whole text in every case. Equal long texts are encoded once.

    A null text is encoded as the empty one: no ids. Repeated rows are all returned, null
    identifiers and the order of nothing matter, and columns outside ``keep`` are not looked at.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    long = F.length("_text") > chunk
    short = _encode_pieces(rows.filter(~long), keep, ranks_path, pattern)

    keyed = rows.filter(long).withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256))
    chunks = _chunks(keyed.groupBy("_key").agg(F.min("_text").alias("_text")), chunk, overlap)
    pieces = _stitch(chunks, pattern, chunk, overlap)
    whole = (
        _encode_pieces(pieces, ("_key", "_piece"), ranks_path, pattern)
        .groupBy("_key")
        .agg(F.array_sort(F.collect_list(F.struct("_piece", "ids"))).alias("parts"))
        .select("_key", F.flatten("parts.ids").alias("ids"))
    )
    return short.unionByName(keyed.select(*keep, "_key").join(whole, "_key").select(*keep, "ids"))


def _fields(df: DataFrame, keep: tuple[str, ...], *more: T.StructField) -> T.StructType:
    return T.StructType([df.schema[name] for name in keep] + list(more))


def _encode_pieces(
    df: DataFrame, keep: tuple[str, ...], ranks_path: str, pattern: str
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoding(ranks_path, pattern)
        for part in (part for batch in batches for part in slices(batch, "_text")):
            ids = [
                np.array(coder.encode_ordinary(t), np.int32)
                for t in part.column("_text").to_pylist()
            ]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([*ids, np.empty(0, np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(name) for name in keep), lists], [*keep, "ids"]
            )

    return df.select(*keep, "_text").mapInArrow(
        run, _fields(df, keep, T.StructField("ids", T.ArrayType(T.IntegerType())))
    )


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, begin in enumerate(range(0, len(body), chunk)):
                    part = body[begin : begin + chunk + overlap]
                    yield pa.RecordBatch.from_pydict({"_key": [key], "_chunk": [k], "_body": [part]})

    spread = texts.select("_key", "_text").mapInArrow(run, "_key string, _chunk long, _body string")
    return spread.repartition("_key", "_chunk")


def _stitch(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(_key, _piece, _text): the stretches between the cuts, numbered in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("_body").to_pylist()
            sides = [
                (
                    certain_boundaries(body, pattern, 0, overlap),
                    certain_boundaries(body[chunk - overlap :], pattern, overlap, 2 * overlap),
                )
                for body in bodies
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "_key": batch.column("_key"),
                    "_chunk": batch.column("_chunk"),
                    "head": pa.array([h for h, _ in sides], pa.list_(pa.int64())),
                    "tail": pa.array(
                        [[x - overlap for x in t] for _, t in sides], pa.list_(pa.int64())
                    ),
                }
            )

    marks = chunks.mapInArrow(run, "_key string, _chunk long, head array<long>, tail array<long>")
    order = Window.partitionBy("_key").orderBy("_chunk")
    shared = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    cuts = (
        marks.select("_key", "_chunk", shared.alias("after"))
        .withColumn("before", F.lag("after").over(order))
        .withColumn(
            "_piece",
            F.coalesce(
                F.sum(F.col("after").isNotNull().cast("long")).over(
                    order.rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .withColumn("last", F.lead("_chunk").over(order).isNull())
    )
    # What a chunk gives to its piece: from its cut on, up to the next cut, else up to the next chunk.
    begin = F.coalesce("before", F.lit(0))
    end = F.when(F.col("after").isNotNull(), F.col("after") + chunk).when(
        ~F.col("last"), F.lit(chunk)
    )
    part = F.substr(
        F.col("_body"), (begin + 1).cast("int"), F.coalesce(end - begin, F.length("_body")).cast("int")
    )
    return (
        chunks.join(cuts, ["_key", "_chunk"])
        .groupBy("_key", "_piece")
        .agg(F.array_sort(F.collect_list(F.struct("_chunk", part.alias("part")))).alias("parts"))
        .select("_key", "_piece", F.array_join("parts.part", "").alias("_text"))
    )


def decode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    keep: tuple[str, ...] = ("doc_id",),
    ids: str = "ids",
) -> DataFrame:
    """The columns ``keep`` and ``bytes``: the raw bytes of each row's ids, concatenated.

    Null ids give null, no ids the empty string of bytes. An id outside the ranks raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoding(ranks_path, pattern)
        for batch in batches:
            # One row's ids at a time become Python numbers.
            raw = [
                coder.decode_bytes(x.values.to_pylist()) if x.is_valid else None
                for x in batch.column("_ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(raw, pa.binary())],
                [*keep, "bytes"],
            )

    wanted = df.select(*keep, F.col(ids).alias("_ids"))
    return wanted.mapInArrow(run, _fields(wanted, keep, T.StructField("bytes", T.BinaryType())))
