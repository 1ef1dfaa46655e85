"""Token pieces of documents, packed into sequences by the sum-of-squares rule."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

LIMIT = 4096
END_ID = 1
# Pieces that one task packs; a group leaves a handful of sequences that are not full.
GROUP_PIECES = 20_000
# Distinct strings whose ids a task remembers before it starts over.
REMEMBERED = 400_000

# Up to U+017F every character class below is certain and composition changes nothing; texts with
# other characters, or with control characters, go through the tokenizer as a whole.
PLAIN = re.compile("[\t-\r -~¡-¬®-įĲ-ſ]*")
LETTERS, NUMBERS = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+"
)


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _WordIds(dict):
    """Ids (little-endian unsigned 32-bit) of strings without white space, remembered."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.model, self.table = tokenizer.model, byte_characters()
        # a text that may hold one of these goes through the tokenizer as a whole
        self.added = [token.content.lower() for token in tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = [
            token.id
            for word in WORDS.findall(unit)
            for token in self.model.tokenize(word.encode().decode("latin-1").translate(self.table))
        ]
        found = self[unit] = np.array(ids, "<u4").tobytes()
        return found


def token_bytes(texts: list[str], tokenizer: Tokenizer, words: _WordIds) -> list[bytes]:
    """The ids of each text, without special tokens, as little-endian unsigned 32-bit integers."""
    found = []
    for text in texts:
        lower = text.lower() if PLAIN.fullmatch(text) else None
        if lower is not None and not any(token in lower for token in words.added):
            found.append(b"".join(map(words.__getitem__, lower.split())))
        else:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            found.append(np.array(ids, "<u4").tobytes())
    return found


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    end_id: int = END_ID,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """One row per piece: the columns ``keep``, piece (int, from 0), start, length (long), ids.

    A document is the ids of its text and then ``end_id``; one longer than ``limit`` is cut into
    pieces of ``limit`` ids, of which the last may be shorter. ``ids`` is binary, little-endian
    unsigned 32-bit. A null or empty text is the one id ``end_id``; every row gives its own
    pieces, repeated ones and those with null identifiers too.
    """
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.from_file(tokenizer_path)
        words = _WordIds(tokenizer)
        for batch in batches:
            rows, pieces, starts, ids = [], [], [], []
            for row, text in enumerate(batch.column("_text").to_pylist()):
                whole = token_bytes([text], tokenizer, words)[0] + ending
                for piece, at in enumerate(range(0, len(whole), 4 * limit)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    ids.append(whole[at : at + 4 * limit])
            kept = batch.select(list(keep)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *kept.columns,
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                [*keep, "piece", "start", "length", "ids"],
            )

    schema = T.StructType([rows.schema[name] for name in keep] + fields)
    return rows.mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed longest first.

    ``open_bins[g]`` counts the bins with a gap of g. A piece of length s that goes into a bin of
    gap g turns that bin into one of gap g - s, which changes the sum of the squared counts by
    2 * (open_bins[g - s] - open_bins[g]) + 2; a new bin or a bin that becomes full changes one
    count only. The gap with the least sum is taken, of equal ones the smallest.
    """
    open_bins = np.zeros(limit + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(limit + 1)]
    fill: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    far = np.iinfo(np.int64).max
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        after = 2 * open_bins[: limit - size + 1] + 1
        after[0] = 0
        before = 2 * open_bins[size:] - 1
        change = np.where(open_bins[size:] > 0, after - before, far)
        change[-1] = after[-1]
        gap = size + int(np.argmin(change))
        if gap == limit:
            place = len(fill)
            fill.append(0)
        else:
            place = stacks[gap].pop()
            open_bins[gap] -= 1
        bins[item], offsets[item] = place, fill[place]
        fill[place] += size
        if gap > size:
            stacks[gap - size].append(place)
            open_bins[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, limit: int = LIMIT, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset (long): every piece whole, in a sequence of ``limit``.

    ``pieces`` is a written table with a column ``length`` of 1 to ``limit``. A full piece is a
    sequence of its own. The others are dealt at random (with a fixed seed) into groups of about
    ``group_pieces``, and each group is packed by ``sum_of_squares``; a key that many rows share
    therefore makes no group large, and a group leaves two or three sequences that are not nearly
    full, whatever its size. Offsets have no gaps. An empty table gives an empty one; columns
    named sequence_id or offset are replaced. Ties of length are placed in the order of reading.
    """
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*rest)
    full = pieces.filter(F.col("length") >= limit).select(
        *rest, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    groups = max(1, -(-pieces.filter(F.col("length") < limit).count() // group_pieces))
    dealt = pieces.filter(F.col("length") < limit).withColumn(
        "_group", F.floor(F.rand(17) * groups).cast("long")
    )
    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([dealt.schema[c] for c in (*rest, "_group")] + fields)

    def place(group: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = sum_of_squares(group["length"].to_numpy(), limit)
        # Sequences of the groups lie apart from each other and from those of the full pieces.
        first = (1 << 62) + int(group["_group"].iloc[0]) * (1 << 32) if len(group) else 0
        return group.assign(sequence_id=first + bins, offset=offsets)

    packed = dealt.groupBy("_group").applyInPandas(place, schema).select(*rest, "sequence_id", "offset")
    return full.unionByName(packed)
