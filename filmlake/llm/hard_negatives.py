"""Hard negatives by an inverted multi-index: exact searches that stop at certified windows.

Each half of a vector has a codebook of its own; the pair of nearest codewords is a row's cell. For a
query, half of it times a codeword, plus its length times the codeword's radius (the farthest half
that any row has from it), bounds the half-score of every row there, and the sum of two such
bounds the score of every row of a cell. A heap over both sorted sequences visits cells by falling
bounds, so that all cells that could still hold a wanted row are a beginning of the visit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from filmlake.session import materialize

from .common import partitions

ANCHOR_EVERY, SHIFT_EVERY, CLASSES = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these parts, in per cent, of the positive's.
LOW, HIGH = 50, 95
# The codebooks are fitted to so many rows at most, the first by a hash of their number.
FIT_ROWS = 20_000
ROUNDS = 8
CELL_ROWS, MOST_WORDS = 50, 256
# A first visit ends when its cells hold so many rows.
FIRST_ROWS = 1_000
# Rows of a codeword, and queries that visit it, are shared out to tasks of so many.
SLICE_ROWS, QUERY_ROWS = 20_000, 20_000
SCORES_AT_ONCE = 2_000_000


class Index(NamedTuple):
    """Codewords and radii of both halves, and the number of rows in each cell."""

    first: np.ndarray
    second: np.ndarray
    radius: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each codeword of each half, a bound of the half-scores of all rows there."""
        found, at = [], self.first.shape[1]
        for half, words, radius in zip((query[:at], query[at:]), (self.first, self.second), self.radius):
            length = np.linalg.norm(half)
            reach = length * radius
            # room for the rounding of sums of floating-point numbers
            room = 1e-9 * (length * np.linalg.norm(words, axis=1) + reach) + 1e-6
            found.append(words @ half + reach + room)
        return found[0], found[1]

    def visit(self, query: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, codeword of the first half, of the second) of all cells, by falling bound."""
        first, second = self.bounds(query)
        by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        a, b = first[by_first].tolist(), second[by_second].tolist()
        heap, done = [(-(a[0] + b[0]), 0, 0)], [0] * len(a)
        while heap:
            bound, x, y = heapq.heappop(heap)
            yield -bound, int(by_first[x]), int(by_second[y])
            done[x] = y + 1
            # a cell joins when its neighbours in both sequences have been visited
            if x + 1 < len(a) and done[x + 1] == y:
                heapq.heappush(heap, (-(a[x + 1] + b[y]), x + 1, y))
            if y + 1 < len(b) and (x == 0 or done[x - 1] > y + 1):
                heapq.heappush(heap, (-(a[x] + b[y + 1]), x, y + 1))


def vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    shift_every: int = SHIFT_EVERY, classes: int = CLASSES,
) -> DataFrame:
    """The written rows that take part: (row, vec_id, label, v), with whole-number components.

    A row with a null label, identifier or vector, or a null or non-finite component takes no part.
    A component x becomes floor(256 x). Where ``shift_every`` divides vec_id the label moves one on.
    """
    x = F.transform(vector, lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    moved = F.when(F.col(vec_id) % shift_every == 0, (F.col(label) + 1) % classes).otherwise(F.col(label))
    taken = rows.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & usable)
    named = taken.select(
        F.col(vec_id).cast("long").alias("vec_id"), moved.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(256 * c)).alias("v"),
    )
    return materialize(named.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(values: pd.Series, width: int, kind: type) -> np.ndarray:
    """Vectors as rows of one array; shorter ones are filled up with zeros."""
    found = np.zeros((len(values), width), kind)
    for at, value in enumerate(values):
        found[at, : len(value)] = value
    return found


def _codebook(sample: np.ndarray, words: int) -> np.ndarray:
    """Centres of ``sample`` by rounds of k-means that begin at its first distinct rows."""
    _, first = np.unique(sample, axis=0, return_index=True)
    centres = sample[np.sort(first)[:words]]
    for _ in range(ROUNDS):
        nearest = _nearest(sample, centres)[0]
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and the distance to it."""
    nearest = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
    return nearest, np.linalg.norm(points - centres[nearest], axis=1)


def build_index(rows: DataFrame, width: int, fit_rows: int = FIT_ROWS) -> tuple[Index, DataFrame]:
    """The index of all ``rows``, and the written rows with their cell (i, j).

    Only the codewords come from a sample; cells, counts and radii cover every row. What the driver
    holds are two codebooks of at most MOST_WORDS and a count for each of their pairs.
    """
    total = rows.count()
    words = int(min(MOST_WORDS, max(1, np.ceil(np.sqrt(total / CELL_ROWS)))))
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(fit_rows).select("v").toPandas()
    sample = _matrix(some["v"], width, np.float64)
    half = (width + 1) // 2
    books = _codebook(sample[:, :half], words), _codebook(sample[:, half:], words)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["v"], width, np.float64)
            (i, near), (j, near2) = _nearest(x[:, :half], books[0]), _nearest(x[:, half:], books[1])
            yield batch.assign(i=i, j=j, r1=near, r2=near2)

    schema = "vec_id long, label long, v array<long>, row long, i int, j int, r1 double, r2 double"
    cells = materialize(rows.select("vec_id", "label", "v", "row").mapInPandas(assign, schema), "cells")
    radius = [np.zeros(len(b)) for b in books]
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    known = cells.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2"))
    for cell in known.collect():  # at most MOST_WORDS squared
        counts[cell.i, cell.j] = cell.n
        radius[0][cell.i] = max(radius[0][cell.i], cell.r1)
        radius[1][cell.j] = max(radius[1][cell.j], cell.r2)
    return Index(*books, tuple(radius), counts), cells.drop("r1", "r2")


def _visits(queries: DataFrame, index: Index, width: int) -> DataFrame:
    """The cells that each query visits next, written: a row for each codeword i, with its js.

    Cells before ``pops`` were visited earlier. The visit ends before the first cell whose bound is
    below ``stop``, or when its cells hold ``least`` rows; ``pops`` becomes the number of cells so far.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, firsts, seconds, pops = [], [], [], []
            query = _matrix(batch["v"], width, np.float64)
            for k in range(len(batch)):
                cells: dict[int, list[int]] = {}
                begin, stop, least = batch["pops"].iloc[k], batch["stop"].iloc[k], batch["least"].iloc[k]
                rows = n = 0
                for bound, i, j in index.visit(query[k]):
                    if n >= begin:
                        if bound < stop or rows >= least:
                            break
                        if index.counts[i, j]:
                            rows += index.counts[i, j]
                            cells.setdefault(i, []).append(j)
                    n += 1
                at += [k] * len(cells)
                firsts += cells.keys()
                seconds += cells.values()
                pops += [n] * len(cells)
            if at:
                yield batch.drop(columns=["pops", "stop", "least"]).iloc[at].assign(i=firsts, js=seconds, pops=pops)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in queries.schema if f.name not in ("pops", "stop", "least")]
    spread = queries.repartition(partitions(queries.sparkSession), "row")
    return materialize(spread.mapInPandas(run, ", ".join([*fields, "i int", "js array<int>", "pops int"])), "visits")


def _first(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of the k highest scores of each line, ties by place; the lowest value is none."""
    none = _none(scores.dtype)
    kept = scores > none
    if scores.shape[1] > k:
        kept &= scores >= np.partition(scores, -k, axis=1)[:, -k, None]
    rows, at = np.nonzero(kept)
    order = np.lexsort((at, -scores[rows, at], rows))
    rows, at = rows[order], at[order]
    among = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[among], at[among]


def _none(kind: np.dtype):
    return -np.inf if kind.kind == "f" else np.iinfo(kind).min + 1


def _search(visits: DataFrame, cells: DataFrame, index: Index, width: int, kind: type, k: int, windows: bool) -> DataFrame:
    """The k best rows of the visited cells for each query, or for each of its windows, written.

    Of each codeword's rows and visitors several tasks take a share, so that a cell which many rows or
    queries meet is no large group. Without windows rows of the query's label count, other than
    itself; with windows the rows of other labels whose score lies inside.
    """
    slices = [max(1, int(-(-n // SLICE_ROWS))) for n in index.counts.sum(axis=1)]
    asked = dict(visits.groupBy("i").count().collect())  # at most MOST_WORDS
    parts = [max(1, -(-asked.get(i, 0) // QUERY_ROWS)) for i in range(len(slices))]

    def share(numbers: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, numbers)), F.col("i"))

    def dealt(column: Column) -> Column:
        return F.pmod(F.xxhash64("row"), column).cast("int")

    def all_of(column: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), column - 1))

    left = visits.withColumn("part", dealt(share(parts))).withColumn("slice", all_of(share(slices)))
    right = cells.join(F.broadcast(visits.select("i").distinct()), "i", "left_semi")
    right = right.withColumn("slice", dealt(share(slices))).withColumn("part", all_of(share(parts)))
    group = ("i", "slice", "part")

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"row": [], "window": [], "other": [], "vec_id": [], "score": []}, dtype="int64")]
        if len(queries) and len(rows):
            rows = rows.sort_values(["j", "vec_id", "row"], ignore_index=True)
            slab = max(1, SCORES_AT_ONCE // len(rows))
            for begin in range(0, len(queries), slab):
                found += _scored(queries.iloc[begin : begin + slab], rows, width, kind, k, windows)
        return pd.concat(found, ignore_index=True)

    schema = "row long, window int, other long, vec_id long, score long"
    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(run, schema)
    return materialize(met, "found")


def _scored(queries: pd.DataFrame, rows: pd.DataFrame, width: int, kind: type, k: int, windows: bool) -> list[pd.DataFrame]:
    """The best rows of a slab of queries, as frames."""
    q, x = _matrix(queries["v"], width, kind), _matrix(rows["v"], width, kind)
    scores = np.full((len(q), len(x)), _none(np.dtype(kind)), kind)
    visitors: dict[int, list[int]] = {}
    for at, js in enumerate(queries["js"]):
        for j in js:
            visitors.setdefault(int(j), []).append(at)
    ends = np.searchsorted(rows["j"], np.arange(int(rows["j"].max()) + 2))
    for j, at in visitors.items():
        if j + 1 < len(ends) and ends[j] < ends[j + 1]:
            scores[at, ends[j] : ends[j + 1]] = q[at] @ x[ends[j] : ends[j + 1]].T
    # from here on rows are in the order of their identifiers, which decides ties
    order = np.lexsort((rows["row"], rows["vec_id"]))
    scores, labels = scores[:, order], rows["label"].to_numpy()[order]
    names, ids = rows["row"].to_numpy()[order], rows["vec_id"].to_numpy()[order]
    same = queries["label"].to_numpy()[:, None] == labels
    none, own = _none(scores.dtype), queries["row"].to_numpy()

    def frame(wanted: np.ndarray, window: int) -> pd.DataFrame:
        left = np.where(wanted, scores, none)
        of, at = _first(left, k)
        return pd.DataFrame(
            {"row": own[of], "window": window, "other": names[at], "vec_id": ids[at], "score": left[of, at].astype("int64")}
        )

    if not windows:
        return [frame(same & (own[:, None] != names), 0)]
    found = []
    for window in range(max(map(len, queries["low"]))):
        has = np.array([window < len(low) for low in queries["low"]])
        low, high = (
            np.array([v[window] if window < len(v) else 0 for v in queries[c]]).astype(kind)[:, None] for c in ("low", "high")
        )
        found.append(frame(~same & has[:, None] & (scores >= low) & (scores <= high), window))
    return found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("row", "window").orderBy(F.col("score").desc(), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    ``rows`` is the result of :func:`vectors`. Anchors are the rows whose vec_id ``anchor_every``
    divides; a score is an integer inner product, missing components count as 0. An anchor's positives
    are its first other rows of its label; of each, the negatives are the first rows of other labels
    whose score is ``low`` to ``high`` per cent of the positive's. Higher scores come first, ties by
    smaller vec_id; a repeated row is a row of its own. Each search first visits some cells, whose k-th
    score then certifies where the visit may stop: no cell beyond can hold a better row. An empty
    table gives an empty result. Scores beyond 63 bits are refused.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    size = F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")
    width, most = rows.agg(*size).first()
    if not width:
        return rows.sparkSession.createDataFrame([], schema)
    if width * (most or 0) ** 2 >= 1 << 62:
        raise ValueError("scores beyond 63 bits")
    kind = np.float64 if width * (most or 0) ** 2 < 1 << 53 else np.int64
    index, cells = build_index(rows, width, fit_rows)
    anchors = cells.filter(F.col("vec_id") % anchor_every == 0).select("row", "vec_id", "label", "v")
    anchors = materialize(anchors, "anchors")
    until_end, everything = F.lit(float("-inf")), F.lit(1 << 62)

    asked = anchors.select("row", "label", "v", F.lit(0).alias("pops"))
    visits = _visits(asked.withColumns({"stop": until_end, "least": F.lit(FIRST_ROWS).cast("long")}), index, width)
    found = _search(visits, cells, index, width, kind, positives, False)
    kth = _ranked(found, positives).groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    stop = F.when(F.col("n") >= positives, F.col("kth").cast("double")).otherwise(until_end).alias("stop")
    asked = asked.drop("pops").join(visits.groupBy("row").agg(F.max("pops").alias("pops")), "row")
    asked = asked.join(kth, "row", "left").select("row", "label", "v", "pops", stop, everything.alias("least"))
    more = _search(_visits(asked, index, width), cells, index, width, kind, positives, False)
    best = _ranked(found.unionByName(more), positives).filter("score >= 0")
    chosen = materialize(
        best.select(
            "row", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            _percent("score", low, 99).alias("low"), _percent("score", high, 0).alias("high"),
        ),
        "positives",
    )

    windows = chosen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("w"))
    asked = anchors.select("row", "label", "v").join(windows, "row")
    asked = asked.select("row", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    least_high = F.array_min("high").cast("double")
    visits = _visits(asked.withColumns({"pops": F.lit(0), "stop": least_high, "least": everything}), index, width)
    found = _search(visits, cells, index, width, kind, negatives, True)
    third = _ranked(found, negatives).groupBy("row", "window").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    # where fewer were found, rows down to the window's low end are still wanted
    need = F.when(F.col("n") >= negatives, F.col("kth")).otherwise(F.col("low"))
    needs = chosen.join(third, ["row", "window"], "left").groupBy("row").agg(F.min(need).cast("double").alias("stop"))
    seen = visits.groupBy("row").agg(F.max("pops").alias("pops"))
    asked = asked.join(needs, "row").join(seen, "row", "left").withColumns(
        {"pops": F.coalesce("pops", F.lit(0)), "least": everything}
    )
    more = _search(_visits(asked, index, width), cells, index, width, kind, negatives, True)
    best = _ranked(found.unionByName(more), negatives).select(
        "row", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return best.join(chosen, ["row", "window"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _percent(score: str, share: int, room: int) -> Column:
    """``share`` per cent of a score that is not negative, in whole numbers; ``room`` 99 rounds up."""
    return F.expr(f"cast((cast({score} as decimal(38, 0)) * {share} + {room}) div 100 as bigint)")
