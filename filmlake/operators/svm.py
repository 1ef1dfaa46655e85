"""A linear support vector machine with a plane for each pair of classes, fitted in shared passes.

One pass over the training rows sums what the planes of all pairs need. The hinge is rounded off
over a width; Newton steps find the optimum for that width, which then shrinks. The slopes of the
rounded losses are a dual solution, so every pass also gives the duality gap of the machine
itself, and a pair is done when its gap is small enough. How rows are dealt to tasks and how many
tasks there are changes nothing but the time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .partial_sums import SCHEMA, added, batch_of

# Numbers that the second derivatives of all pairs have together at most.
MOST_NUMBERS = 16_000_000
# Margins that a task computes together.
WORK = 2_000_000
# The width of the rounding, at first and as a part of the last one.
WIDTH, NARROWER = 4.0, 0.1
# An intercept moves by about so much at most where no row bends the losses.
MOST_MOVE = 2.0
# What a missed step multiplies the damping by, and a good one divides it by.
TIGHTER, LOOSER = 8.0, 4.0


class Planes(NamedTuple):
    """Classes in order; of each pair (first < second) the plane whose positive side is the first.

    ``objectives`` are those of the machine, ``gaps`` how far at most they are above the least ones.
    """

    classes: list
    first: np.ndarray
    second: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    objectives: np.ndarray
    gaps: np.ndarray


class _Sums(NamedTuple):
    """Of each pair: rounded and plain losses, sum of the duals, first and second derivatives."""

    rounded: np.ndarray
    hinge: np.ndarray
    duals: np.ndarray
    slope: np.ndarray
    bend: np.ndarray


def _pairs(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, second) of all pairs, and for (class, other) the pair's number and the class's sign."""
    first, second = np.triu_indices(k, 1)
    number, sign = np.zeros((k, k), int), np.zeros((k, k))
    number[first, second] = number[second, first] = np.arange(len(first))
    sign[first, second], sign[second, first] = 1.0, -1.0
    return first, second, number, sign


def _pass(rows: DataFrame, planes: np.ndarray, widths: np.ndarray, live: np.ndarray, k: int, cost: float) -> _Sums:
    """The sums over all rows for the pairs that are ``live``, in one job."""
    n, d = planes.shape
    sent = rows.sparkSession.sparkContext.broadcast((planes, widths, live))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, widths, live = sent.value
        _, _, number, sign = _pairs(k)
        found = np.zeros((n, 3 + d + d * d))
        for batch in batches:
            c = batch.column("c").to_numpy()
            x = np.ones((len(c), d))
            if len(c):
                x[:, :-1] = batch.column("x").flatten().to_numpy().reshape(len(c), d - 1)
            for own in np.unique(c):
                others = np.flatnonzero((sign[own] != 0) & live[number[own]])
                here = np.flatnonzero(c == own)
                for part in np.array_split(here, -(-len(here) * max(len(others), d * d) // WORK)):
                    pair, y = number[own, others], sign[own, others]
                    found[pair] += _summed(x[part], planes[pair], y, widths[pair], cost)
        yield batch_of(found.ravel())

    sums = rows.select("x", "c").mapInArrow(run, SCHEMA)
    flat = added(sums, n * (3 + d + d * d), rows.rdd.getNumPartitions()).reshape(n, -1)
    sent.unpersist()
    return _Sums(*flat[:, :3].T, flat[:, 3 : 3 + d], flat[:, 3 + d :].reshape(n, d, d))


def _summed(x: np.ndarray, planes: np.ndarray, y: np.ndarray, widths: np.ndarray, cost: float) -> np.ndarray:
    """What the rows ``x`` of one class add to each of its pairs, as a line of sums."""
    short = 1 - y * (x @ planes.T)
    inside = (short > 0) & (short <= widths)
    over = np.maximum(short, 0)
    rounded = np.where(inside, over**2 / (2 * widths), np.maximum(over - widths / 2, 0))
    duals = cost * np.clip(short / widths, 0, 1)
    squares = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    bend = (cost / widths)[:, None] * (inside.T.astype(float) @ squares)
    slope = -y[:, None] * (duals.T @ x)
    return np.column_stack([cost * rounded.sum(axis=0), cost * over.sum(axis=0), duals.sum(axis=0), slope, bend])


def fit(
    train: DataFrame, features: str, label: str, classes: list, cost: float = 2.0, tolerance: float = 1e-3,
    max_passes: int = 200,
) -> Planes:
    """The planes of all pairs of ``classes`` (M12): half the squared length of the weights plus ``cost``
    times the hinge losses of the pair's rows, the intercept free.

    ``features`` is a list of numbers, of one length in all rows. A pair is done when its duality gap is
    at most ``tolerance`` times its objective; ``gaps`` tells what was reached. The passes keep no state
    but the planes, so a lost executor costs a part of one pass. Rows with a null label, of other
    classes or without features are left out.
    """
    k = len(classes)
    first, second, _, _ = _pairs(k)
    table = F.array(*map(F.lit, classes)) if classes else F.array().cast("array<int>")
    place = (F.array_position(table, F.col(label)) - 1).cast("int").alias("c")
    rows = train.select(F.col(features).cast("array<double>").alias("x"), place).filter("c >= 0 and x is not null")
    rows = materialize(rows, "svm-rows")
    d = (rows.agg(F.max(F.size("x"))).first()[0] or 0) + 1
    if len(first) * d * d > MOST_NUMBERS:
        raise ValueError(f"{len(first)} planes of {d - 1} features are too many to be fitted together")
    planes, n = np.zeros((len(first), d)), len(first)
    penalised = np.append(np.ones(d - 1), 0.0)
    widths, live = np.full(n, WIDTH), np.ones(n, bool)
    gaps, objectives, best = np.full(n, np.inf), np.full(n, np.inf), planes.copy()
    step, expected = np.zeros((n, d)), np.zeros(n)
    value, damping = np.full(n, np.inf), np.zeros(n)
    slopes, bends = np.zeros((n, d)), np.zeros((n, d, d))
    passes = 0
    while live.any() and passes < max_passes:
        trial = planes + step
        sums = _pass(rows, trial, widths, live, k, cost)
        passes += 1
        length = ((trial * penalised) ** 2).sum(axis=1) / 2
        objective = length + sums.hinge
        # a dual solution whose signed sum is not quite 0 is charged for it
        dual = sums.duals - (sums.slope[:, :-1] ** 2).sum(axis=1) / 2
        charge = np.abs(sums.slope[:, -1]) * (1 + np.abs(trial[:, -1]))
        gap = objective - dual + charge
        better = live & (gap < gaps)
        gaps[better], objectives[better], best[better] = gap[better], objective[better], trial[better]
        live &= gaps > tolerance * np.maximum(objectives, 1e-12)
        now = length + sums.rounded
        taken = live & (now <= value + 1e-4 * expected + 1e-12 * np.abs(now))
        planes[taken], value[taken] = trial[taken], now[taken]
        slopes[taken], bends[taken] = (trial * penalised + sums.slope)[taken], sums.bend[taken]
        # a step that did not help is made shorter and steeper by damping, a good one takes some away
        missed = live & ~taken
        damping[taken] /= LOOSER
        damping[missed] = np.maximum(damping[missed] * TIGHTER, 1e-4)
        at = np.flatnonzero(live)
        step[at], expected[at] = _newton(slopes[at], bends[at], damping[at], penalised)
        # the optimum for this width is near, also without damping: what is left comes from the width
        promised = _newton(slopes[at], bends[at], 0 * damping[at], penalised)[1]
        done = np.zeros(n, bool)
        small = 0.1 * tolerance * np.maximum(value, 1e-12)
        done[at] = (taken & (charge < small))[at] & (-promised < small[at])
        widths[done] *= NARROWER
        value[done], expected[done], step[done], damping[done] = np.inf, 0.0, 0.0, 0.0
    return Planes(classes, first, second, best[:, :-1], best[:, -1], objectives, gaps)


def _newton(slopes: np.ndarray, bends: np.ndarray, damping: np.ndarray, penalised: np.ndarray):
    """A damped Newton step of each pair, and the change that its slope promises."""
    d = slopes.shape[1]
    scale = 1 + np.trace(bends, axis1=1, axis2=2) / d
    curved = bends + np.diag(penalised) + (damping * scale)[:, None, None] * np.eye(d)
    # where no row bends the losses, the intercept moves by a bounded step
    curved[:, -1, -1] = np.maximum(curved[:, -1, -1], np.abs(slopes[:, -1]) / MOST_MOVE + 1e-9)
    step = -np.linalg.solve(curved, slopes[:, :, None])[:, :, 0]
    return step, (step * slopes).sum(axis=1)


def votes(df: DataFrame, planes: Planes, features: str, prediction: str = "predicted") -> DataFrame:
    """The class that wins the most pairs, ties to the smaller class.

    A row without features has no prediction.
    """
    sent = df.sparkSession.sparkContext.broadcast(planes)
    rows = df.select("*", F.lit(None).cast("int").alias("_won"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = sent.value
        k, width = len(planes.classes), planes.weights.shape[1]
        for batch in batches:
            lists = batch.column(features)
            whole = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)) if k else np.zeros(0, int)
            won = np.zeros(batch.num_rows, np.int32)
            for at in np.array_split(whole, len(whole) * len(planes.first) // WORK + 1):
                if len(at) and len(planes.first):
                    x = lists.take(pa.array(at)).flatten().to_numpy().astype(float).reshape(len(at), width)
                    ahead = x @ planes.weights.T + planes.intercepts > 0
                    counts = np.zeros((len(at), k), int)
                    np.add.at(counts, (np.arange(len(at))[:, None], np.where(ahead, planes.first, planes.second)), 1)
                    won[at] = counts.argmax(axis=1)
            missing = np.ones(batch.num_rows, bool)
            missing[whole] = False
            columns = [*batch.columns[:-1], pa.array(won, pa.int32(), mask=missing)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    won = rows.mapInArrow(run, rows.schema)
    table = F.array(*map(F.lit, planes.classes)) if planes.classes else F.array().cast("array<int>")
    return won.withColumn(prediction, F.get(table, F.col("_won"))).drop("_won")
