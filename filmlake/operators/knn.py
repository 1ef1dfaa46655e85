"""Exact k-nearest-neighbour classification on a few standardised numeric features.

The training points are indexed by a tree of boxes that is a table: quantiles of each feature cut
space into cells, a cell's path names the boxes it lies in from the whole space down, and every box
has its number of points and their real extent. A box of few points is a leaf and is cut no further.
A test point first searches the leaf it falls in. The distance of the k-th neighbour found there, or
the far corners of boxes around it that hold k points, bounds what is left; then the tree is walked
down by joins on the path, through the boxes that come nearer than the bound. The tree is neither on
the driver nor in a closure, a leaf with many points or queries is served by several tasks, and no
table of all pairs exists at any time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize

BOX_POINTS = 2_000
# Bits of a box's number among its siblings, about, and the most quantile bits of a feature.
FAN_BITS, MOST_BITS = 3, 12
BOX_QUERIES = 20_000
SLICE_POINTS = 4 * BOX_POINTS
_FOUND = "qid long, d2 double, id long, label int"


def standardise(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    moments = source.agg(
        F.struct(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        )
    ).scalar()
    scaled = {
        c: F.when(moments[f"s{i}"] == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col(c) - moments[f"m{i}"], moments[f"s{i}"])
        )
        for i, c in enumerate(columns)
    }
    return df.withColumns(scaled)


def _gap2(point: Column, low: Column, high: Column, d: int) -> Column:
    """The squared distance from a point to a box."""
    sides = [F.greatest(low[i] - point[i], point[i] - high[i], F.lit(0.0)) for i in range(d)]
    return sum((s * s for s in sides[1:]), sides[0] * sides[0])


def _far2(point: Column, low: Column, high: Column, d: int) -> Column:
    """The squared distance from a point to the farthest corner of a box."""
    sides = [F.greatest(F.abs(low[i] - point[i]), F.abs(high[i] - point[i])) for i in range(d)]
    return sum((s * s for s in sides[1:]), sides[0] * sides[0])


class BoxTree:
    """A tree of boxes over the ``point`` arrays of a table, kept as tables.

    ``nodes``: path, parent, level, points, low, high, leaf. The root has the path "0" and no
    parent. A box with at most ``BOX_POINTS`` points is a leaf, so is one whose quantiles are used
    up. ``homes`` are the rows of ``points`` with the leaf that holds each, ``box``. The driver
    holds the quantiles, at most 2 ** ``MOST_BITS`` of a feature, and the depth.
    """

    def __init__(self, points: DataFrame, d: int, total: int):
        self.d = d
        self.step = max(1, FAN_BITS // d)
        wanted = math.ceil(math.log2(max(2.0, total / BOX_POINTS)) / (d * self.step))
        # features that go together need more cuts than independent ones
        self.levels = max(1, min(wanted + 2, MOST_BITS // self.step))
        self.borders = self._quantiles(points)
        coded = self.coded(points)
        extent = [f(F.get("point", F.lit(i))).alias(f"{n}{i}") for i in range(d) for n, f in (("low", F.min), ("high", F.max))]
        cells = materialize(
            coded.groupBy("paths").agg(F.count(F.lit(1)).alias("points"), *extent), "knn-cells"
        )
        merged = [f(f"{n}{i}").alias(f"{n}{i}") for i in range(d) for n, f in (("low", F.min), ("high", F.max))]
        boxes = materialize(
            cells.select(F.posexplode("paths").alias("level", "path"), *cells.columns[1:])
            .groupBy("level", "path")
            .agg(F.sum("points").alias("points"), *merged)
            .select(
                "path",
                F.when(F.col("level") > 0, F.regexp_replace("path", r"\.[0-9]+$", "")).alias("parent"),
                "level",
                "points",
                *[F.array(*[f"{n}{i}" for i in range(d)]).alias(n) for n in ("low", "high")],
                ((F.col("points") <= BOX_POINTS) | (F.col("level") == self.levels)).alias("leaf"),
            ),
            "knn-boxes",
        )
        cut = boxes.filter(~F.col("leaf")).select(F.col("path").alias("parent"))
        # The parents of what is kept were cut, so they are kept themselves.
        below = boxes.join(broadcast_checked(cut), "parent", "left_semi").select(*boxes.columns)
        self.nodes = materialize(below.unionByName(boxes.filter("level = 0")), "knn-tree")
        self.depth = self.nodes.agg(F.max("level")).first()[0] or 0
        leaves = self.nodes.filter("leaf").select(F.col("path").alias("box"))
        cell_box = cells.select("paths", F.explode("paths").alias("box")).join(
            broadcast_checked(leaves), "box", "left_semi"
        )
        self.homes = materialize(
            coded.join(broadcast_checked(materialize(cell_box, "knn-cell-box")), "paths").select(
                *points.columns, "box"
            ),
            "knn-homes",
        )

    def _quantiles(self, points: DataFrame) -> list[list[float]]:
        parts = 1 << self.step * self.levels
        names = [f"x{i}" for i in range(self.d)]
        values = points.select(*[F.get("point", F.lit(i)).alias(n) for i, n in enumerate(names)])
        found = values.approxQuantile(names, [k / parts for k in range(1, parts)], 0.25 / parts)
        return [sorted(set(v)) for v in found]

    def coded(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``paths``: the boxes that hold each ``point``, from the root down."""
        bits = self.step * self.levels
        out = rows
        for i, borders in enumerate(self.borders):
            out = out.withColumn(f"_x{i}", F.get("point", F.lit(i)))
            splits = [-math.inf, *borders, math.inf]
            if len(splits) < 3:
                splits.insert(1, 0.0)
            out = Bucketizer(splits=splits, inputCol=f"_x{i}", outputCol=f"_b{i}").transform(out)
            # equal quantiles leave fewer buckets; they are spread over all numbers
            out = out.withColumn(f"_b{i}", F.floor(F.col(f"_b{i}") * (1 << bits) / (len(splits) - 1)).cast("int"))
        paths, path = [F.lit("0")], F.lit("0")
        for level in range(1, self.levels + 1):
            digit = F.lit(0)
            for i in range(self.d):
                part = F.shiftright(F.col(f"_b{i}"), bits - level * self.step).bitwiseAND((1 << self.step) - 1)
                digit = digit * (1 << self.step) + part
            path = F.concat(path, F.lit("."), digit.cast("string"))
            paths.append(path)
        return out.select(*rows.columns, F.array(*paths).alias("paths"))

    def located(self, queries: DataFrame, k: int) -> DataFrame:
        """(qid, point, own, bound): the leaf that a query falls in, null in empty space, and a
        squared distance within which there are k points, or all."""
        chain = self.coded(queries).select("qid", "point", F.explode("paths").alias("path"))
        boxes = chain.join(broadcast_checked(self.nodes), "path")
        far = _far2(F.col("point"), F.col("low"), F.col("high"), self.d)
        leaf, inner = F.col("leaf"), F.struct("level", "path")
        around = materialize(
            boxes.groupBy("qid").agg(
                F.first("point").alias("point"),
                F.max(F.when(leaf, F.col("path"))).alias("own"),
                F.max(F.when(leaf, F.col("points"))).alias("held"),
                F.max(F.when(~leaf, inner)).getField("path").alias("inner"),
                F.min(F.when((F.col("points") >= k) | (F.col("level") == 0), far)).alias("bound"),
            ),
            "knn-around",
        )
        # Where the leaf holds too few, the nearest of its siblings that together hold k.
        few = around.filter(F.col("own").isNull() | (F.col("held") < k)).select("qid", "point", "inner")
        children = self.nodes.select(F.col("parent").alias("inner"), "points", "low", "high")
        nearer = W.partitionBy("qid").orderBy("far").rowsBetween(W.unboundedPreceding, W.currentRow)
        closer = (
            few.join(broadcast_checked(children), "inner")
            .select("qid", far.alias("far"), "points")
            .withColumn("sum", F.sum("points").over(nearer))
            .filter(F.col("sum") >= k)
            .groupBy("qid")
            .agg(F.min("far").alias("closer"))
        )
        bound = F.least("bound", "closer").alias("bound")
        return around.join(closer, "qid", "left").select("qid", "point", "own", bound)


    def within(self, queries: DataFrame) -> DataFrame:
        """(qid, point, own, box) of the leaves whose points may lie within ``reach`` of each query.

        One join of each level; a leaf that was reached early leads to itself.
        """
        columns = ["low", "high", F.col("path").alias("to")]
        steps = self.nodes.filter("level > 0").select(F.col("parent").alias("box"), *columns)
        steps = materialize(
            steps.unionByName(self.nodes.filter("leaf").select(F.col("path").alias("box"), *columns)), "knn-steps"
        )
        found = queries.withColumn("box", F.lit("0"))
        near = _gap2(F.col("point"), F.col("low"), F.col("high"), self.d) <= F.col("reach")
        for _ in range(self.depth):
            found = (
                found.join(broadcast_checked(steps), "box")
                .filter(near)
                .select("qid", "point", "own", "reach", F.col("to").alias("box"))
            )
        return found.drop("reach")


def _frame(qid, d2, ids, labels) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "qid": np.asarray(qid, dtype="int64"),
            "d2": np.asarray(d2, dtype="float64"),
            "id": np.asarray(ids, dtype="int64"),
            "label": np.asarray(labels, dtype="int32"),
        }
    )


def _nearest(queries, qids, points, ids, labels, k: int) -> pd.DataFrame:
    """The k nearest points of each query, ties by id, computed a slab of queries at a time."""
    order = np.argsort(ids, kind="stable")
    points, ids, labels = points[order], ids[order], labels[order]
    found = []
    slab = max(1, 4_000_000 // len(points))
    for a in range(0, len(queries), slab):
        part = queries[a : a + slab]
        d2 = np.zeros((len(part), len(points)))
        for axis in range(points.shape[1]):
            d2 += (part[:, axis, None] - points[None, :, axis]) ** 2
        d2 = np.round(d2, 9)
        if len(points) > k:
            rows, at = np.nonzero(d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1 : k])
        else:
            rows, at = np.indices(d2.shape).reshape(2, -1)
        # Points are in the order of their ids, so a stable sort leaves ties in that order.
        sorted_ = np.lexsort((at, d2[rows, at], rows))
        rows, at = rows[sorted_], at[sorted_]
        first = np.searchsorted(rows, rows)
        kept = np.arange(len(rows)) - first < k
        rows, at = rows[kept], at[kept]
        found.append(_frame(qids[a + rows], d2[rows, at], ids[at], labels[at]))
    return pd.concat(found, ignore_index=True)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("qid").orderBy("d2", "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _point(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def _whole(point: Column) -> Column:
    return F.forall(point, lambda x: x.isNotNull() & ~F.isnan(x))


def _search(
    test: DataFrame, train: DataFrame, key: str, label: str, features: Sequence[str], k: int
) -> tuple[DataFrame, DataFrame]:
    """(point, qid) of the distinct test points, and their k nearest (qid, rank, d2, neighbour, of).

    Of equal training points only the k with the smallest keys can ever be neighbours, so a
    value that repeats without limit stays k rows.
    """
    point = _point(features)
    same = W.partitionBy("point").orderBy("id")
    points = materialize(
        train.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"), point.alias("point"))
        .filter(_whole(F.col("point")))
        .withColumn("copy", F.row_number().over(same))
        .filter(F.col("copy") <= k)
        .drop("copy"),
        "knn-train",
    )
    asked = materialize(
        test.groupBy(point.alias("point")).agg(F.min(key).cast("long").alias("qid")).filter(_whole(F.col("point"))),
        "knn-test",
    )
    total = points.count()
    if not total:
        raise ValueError("no training rows")
    tree = BoxTree(points, len(features), total)
    homes = tree.homes
    sizes = tree.nodes.filter("leaf").select(F.col("path").alias("box"), "points")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _frame([], [], [], [])
        return _nearest(
            np.stack(left["point"].to_numpy()), left["qid"].to_numpy(),
            np.stack(right["point"].to_numpy()), right["id"].to_numpy(),
            right["label"].to_numpy(), k,
        )

    def search_boxes(queries: DataFrame) -> DataFrame:
        """Search each query in its box, several tasks sharing many queries or many points."""
        load = (
            queries.groupBy("box")
            .agg(F.ceil(F.count(F.lit(1)) / BOX_QUERIES).cast("int").alias("parts"))
            .join(sizes, "box")
            .select("box", "parts", F.ceil(F.col("points") / SLICE_POINTS).cast("int").alias("slices"))
        )
        load = broadcast_checked(materialize(load, "knn-load"))
        left = queries.join(load, "box").select(
            "box", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "qid", "point",
        )
        right = homes.join(load, "box").select(
            "box", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"),
            "id", "label", "point",
        )
        group = ("box", "part", "slice")
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(search, _FOUND)

    queries = materialize(tree.located(asked, k), "knn-queries")
    own = queries.filter("own is not null").select("qid", "point", F.col("own").alias("box"))
    first = materialize(_best(search_boxes(own), k).drop("rank"), "knn-own-box")
    known = first.groupBy("qid").agg(F.max("d2").alias("d2"), F.count(F.lit(1)).alias("n"))
    # Distances were rounded to 9 places, hence the margin.
    reach = F.least("bound", F.when(F.col("n") >= k, F.col("d2"))) + 1e-8
    near = tree.within(queries.join(known, "qid", "left").select("qid", "point", "own", reach.alias("reach")))
    further = materialize(near.filter(~F.col("box").eqNullSafe(F.col("own"))).drop("own"), "knn-further")
    found = first if further.isEmpty() else first.unionByName(search_boxes(further))
    return asked, _best(found, k).withColumnRenamed("id", "neighbour").withColumnRenamed("label", "of")


def nearest_neighbours(
    test: DataFrame, train: DataFrame, key: str, label: str, features: Sequence[str], k: int = 10
) -> DataFrame:
    """(key, rank, neighbour, d2, label): the k nearest training rows, ties by key.

    ``key`` is a whole number. Distances are compared after rounding to 9 places. Rows with a null
    or NaN feature have no neighbours and are none.
    """
    asked, found = _search(test, train, key, label, features, k)
    back = test.select(key, _point(features).alias("point")).join(asked, "point")
    return back.join(found, "qid").select(
        key, "rank", "neighbour", "d2", F.col("of").alias("label")
    )


def knn_predict(
    test: DataFrame, train: DataFrame, key: str, label: str, features: Sequence[str], k: int = 10
) -> DataFrame:
    """(key, prediction, votes) by majority of the k nearest, ties to the smaller label.

    Votes are counted per distinct test point and only the result is joined back to the rows.
    """
    asked, found = _search(test, train, key, label, features, k)
    counts = found.groupBy("qid", "of").agg(F.count(F.lit(1)).alias("votes"))
    best = counts.groupBy("qid").agg(
        F.max(F.struct("votes", (-F.col("of")).alias("rank"))).alias("b")
    )
    decided = asked.join(best, "qid").select(
        "point", (-F.col("b.rank")).cast("int").alias("prediction"), F.col("b.votes").alias("votes")
    )
    return test.select(key, _point(features).alias("point")).join(decided, "point").drop("point")
