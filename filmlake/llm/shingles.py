"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 5
# Odd numbers: multiplication by them is one-to-one on 64 bits. Fixed, so that sketches of
# different runs can be compared.
BASE = 0x9E3779B97F4A7C15
MIX = (0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value spread evenly, one to one."""
    for factor in MIX:
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the bytes [a, b) hash to (sums[b] - sums[a]) * inverse[a]."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)[:-1], out=sums[1:])
    return sums, powers(pow(BASE, -1, 1 << 64), n)


def word_bytes() -> np.ndarray:
    """Which bytes of UTF-8 belong to a word: ASCII letters and digits, and all of other scripts."""
    table = np.zeros(256, bool)
    table[128:] = True
    for first, last in ("09", "az"):
        table[ord(first) : ord(last) + 1] = True
    return table


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word of the lower-case texts, in order."""
    parts = [t.lower().encode() for t in texts]
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    inside = np.concatenate([[False], word_bytes()[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    sums, inverse = rolling(data)
    hashes = mixed((sums[last] - sums[first]) * inverse[first])
    return hashes, np.searchsorted(begins, first, "right") - 1


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (64 bits) of each text.

    Words are runs of ASCII letters and digits and of all other characters, in lower case. A text
    of fewer words than a shingle is one shingle of all its words; one without words has none.
    """
    hashes, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    state = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        state = mixed(state + hashes[k : k + len(state)])
    alike = owner[: len(state)] == owner[words - 1 :] if len(state) else np.zeros(0, bool)
    state, own = state[alike], owner[: len(alike)][alike]
    ends = np.searchsorted(own, np.arange(len(texts) + 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    found = []
    for k, n in enumerate(counts):
        if 0 < n < words:
            short = np.zeros(1, np.uint64)
            for h in hashes[begins[k] : begins[k + 1]]:
                short = mixed(short + h)
            found.append(short)
        else:
            found.append(np.unique(state[ends[k] : ends[k + 1]]))
    return found
