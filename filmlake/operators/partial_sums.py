"""Sums of long arrays over tasks: each task gives its array in parts, a shuffle adds them up."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

# Numbers of a part; a part is one row of a shuffle.
PART = 1 << 16
# So many numbers of all tasks together come to the driver without a shuffle.
MOST_SENT = 4_000_000
SCHEMA = "part int, sums binary"


def parts_of(flat: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(part, sums) of one task's array of doubles."""
    cut = [flat[at : at + PART].tobytes() for at in range(0, len(flat), PART)]
    return pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())


def batch_of(flat: np.ndarray) -> pa.RecordBatch:
    """The parts as rows of SCHEMA."""
    return pa.RecordBatch.from_arrays([*parts_of(flat)], ["part", "sums"])


def added(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The sum of all ``tasks``' arrays of ``size`` numbers; zeros if no task had rows.

    A few small arrays are added up as they arrive; else a shuffle adds them part by part first.
    """
    if tasks * size <= MOST_SENT:
        flat, at = np.zeros(size), np.arange(0, size, PART)
        for row in parts.collect():
            flat[at[row.part] : at[row.part] + PART] += np.frombuffer(row.sums)
        return flat

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in group["sums"])
        return pd.DataFrame({"part": group["part"].iloc[:1], "sums": [total.tobytes()]})

    rows: Iterable = parts.select("part", "sums").groupBy("part").applyInPandas(add, SCHEMA).collect()
    found = [np.frombuffer(r.sums) for r in sorted(rows)]
    return np.concatenate(found) if found else np.zeros(size)
