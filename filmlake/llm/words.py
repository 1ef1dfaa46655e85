"""The words of many texts at once, as numbers into a dictionary of the distinct ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# What a byte of UTF-8 is to a word: part of it, a gap between words, or the end of a piece.
WORD, GAP, END = 0, 1, 2
# Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def split_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, code, piece, row) of the words of ``texts`` (strings, none null), in order.

    ``kinds`` has WORD, GAP or END for each byte; only ASCII bytes may be other than WORD, so that
    no character is cut. A text's end ends a piece. A-Z become a-z. ``code`` indexes the distinct
    words; ``piece`` only tells pieces apart, also those of different texts.
    """
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    kind = kinds[raw]
    inside = kind == WORD
    first_byte = np.zeros(len(raw) + 1, bool)
    first_byte[ends] = True
    before = np.concatenate(([False], inside))[:-1] & ~first_byte[:-1]
    after = np.concatenate((inside, [False]))[1:] & ~first_byte[1:]
    starts, lasts = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    borders = (kind == END) | first_byte[:-1]
    piece = np.cumsum(borders, dtype=np.int32)[starts]
    row = np.searchsorted(ends, starts, side="right") - 1
    offsets = np.concatenate(([0], np.cumsum(lasts - starts + 1))).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]])]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), piece, row
