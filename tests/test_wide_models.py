"""Models of very many columns of zeros and ones, fitted to the ones alone."""

import pickle

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from filmlake.operators import models, partial_sums, sharded_perceptron, wide_perceptron, wide_rows, wide_trees

N, COLUMNS = 400, 60


def made():
    draw = np.random.default_rng(4)
    rows = []
    for key in range(N):
        ones = np.sort(draw.choice(COLUMNS, draw.integers(0, 9), replace=False))
        y = float((ones < 8).sum() + (ones % 7 == 0).sum() + (draw.random() < 0.1))
        rows.append((key, y, Vectors.sparse(COLUMNS, [(int(i), 1.0) for i in ones])))
    dense = np.zeros(COLUMNS)
    dense[[3, 50]] = 1.0
    return [*rows, (N, 2.0, Vectors.dense(dense))]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(made(), ["k", "y", "features"]).repartition(3).cache()


def predicted(df):
    return {r.k: r.predicted for r in df.select("k", "predicted").collect()}


@pytest.mark.parametrize("depth, leaf", [(30, 1), (4, 6)])
def test_a_tree_of_ones_is_the_tree_of_spark(vectors, depth, leaf):
    train, test = vectors.filter("k % 4 > 0"), vectors
    estimator = models.tree(depth).setMinInstancesPerNode(leaf)
    want = predicted(models.fit_predict(train, test, estimator, "y"))
    got = models.fit_predict_ones(train, test, estimator, "y", most_cells=0)
    assert predicted(got) == want and len(set(want.values())) > 2


def test_a_forest_of_ones(vectors):
    train, test = vectors.filter("k % 4 > 0"), vectors.filter("k % 4 = 0")
    estimator = models.forest(60, 6, 3)
    want = predicted(models.fit_predict(train, test, estimator, "y"))
    wide = models.fit_predict_ones(train, test, estimator, "y", most_cells=0)
    got = predicted(wide)
    truth = {r.k: r.y for r in test.collect()}
    right = [np.mean([p[k] == truth[k] for k in truth]) for p in (want, got)]
    assert got.keys() == want.keys() and abs(right[0] - right[1]) < 0.12
    assert predicted(models.fit_predict_ones(train, test, estimator, "y", most_cells=0)) == got


def test_a_perceptron_of_ones_is_that_of_spark(spark, vectors):
    """Weights that Spark found give the same predictions, and ours are found to be as good."""
    train, test = vectors.filter("k % 4 > 0"), vectors
    values = models.class_values(train, "y")
    layers = [COLUMNS, 5, len(values)]
    indexed = train.withColumn("label", F.array_position(F.array(*map(F.lit, values)), F.col("y")).cast("double") - 1)
    model = models.perceptron((5,), 40).setLayers(layers).fit(indexed)
    want = {r.k: int(r.prediction) for r in model.transform(test).collect()}
    theirs, at = [], 0
    for n_in, n_out in zip(layers, layers[1:]):
        block = model.weights.toArray()[at : at + (n_in + 1) * n_out]
        theirs += [block[: n_in * n_out].reshape(n_in, n_out), block[n_in * n_out :]]
        at += len(block)
    flat = np.concatenate([w.ravel() for w in theirs])
    got = wide_perceptron.predict(wide_rows.pack(test), flat, layers)
    assert {r.k: r.prediction for r in got.collect()} == want
    rows = wide_rows.pack(indexed.select("label", "features"), label="label")
    ours = wide_perceptron.fit(rows, layers, 40, 1e-6, 9)
    losses = [wide_perceptron.evaluate(rows, w, layers)[0] / rows.count() for w in (flat, ours)]
    assert losses[1] < losses[0] + 0.1
    whole = [predicted(models.fit_predict_ones(train, test, models.perceptron((5,), 40), "y", most_cells=0)) for _ in "ab"]
    truth = {r.k: r.y for r in train.collect()}
    right = np.mean([whole[0][k] == truth[k] for k in truth])
    assert whole[0] == whole[1] and right > np.mean([values[want[k]] == truth[k] for k in truth]) - 0.1


def test_the_gradient_of_a_perceptron(vectors, monkeypatch):
    rows = wide_rows.pack(vectors.select(F.col("y").alias("c"), "features").filter("c < 4"), label="c")
    layers = [COLUMNS, 4, 3, 4]
    point = wide_perceptron.first_weights(layers, 1)
    loss, slope = wide_perceptron.evaluate(rows, point, layers)
    monkeypatch.setattr(wide_rows, "SLICE", 17)
    monkeypatch.setattr(partial_sums, "MOST_SENT", 0)
    for at in (0, 7, 4 * COLUMNS + 1, 4 * COLUMNS + 9, len(point) - 1):
        moved = [point.copy(), point.copy()]
        moved[0][at] -= 1e-5
        moved[1][at] += 1e-5
        low, high = (wide_perceptron.evaluate(rows, m, layers)[0] for m in moved)
        assert abs((high - low) / 2e-5 - slope[at]) < 1e-4 * max(1, abs(slope[at]))


def test_a_pass_of_a_perceptron_sends_the_lines_of_its_ones(spark, monkeypatch):
    """Every task sent the whole gradient, so a pass of a wide model took most of its time to send zeros."""
    draw, wide = np.random.default_rng(5), 40_000
    rows = [(float(k % 3), Vectors.sparse(wide, [(int(i), 1.0) for i in sorted(draw.choice(wide, 4, replace=False))])) for k in range(120)]
    rows = wide_rows.pack(spark.createDataFrame([*rows, (1.0, Vectors.sparse(wide, []))], ["y", "features"]).repartition(3), label="y")
    layers = [wide, 6, 3]
    point = wide_perceptron.first_weights(layers, 2)
    parts = wide_perceptron.blocks(rows)
    tasks = parts.count()
    assert wide_perceptron.numbers_sent(parts, layers) <= 4 * 120 * 6 + tasks * 28
    many = spark.createDataFrame(rows.rdd.repartition(40), rows.schema)
    assert wide_perceptron.blocks(many).count() <= spark.sparkContext.defaultParallelism < many.rdd.getNumPartitions()
    loss, slope = wide_perceptron.evaluate(rows, point, layers)
    (lines, shift), (last, last_shift) = wide_perceptron.unpack(point, layers)
    want, (got, got_shift) = np.zeros((wide, 6)), wide_perceptron.unpack(slope, layers)[0]
    total, shifts = 0.0, np.zeros(6)
    for r in rows.collect():
        out = 1 / (1 + np.exp(-(lines[r.ones].sum(axis=0) + shift)))
        chance = np.exp(out @ last + last_shift)
        chance /= chance.sum()
        total -= np.log(chance[r["class"]])
        missed = (last @ (chance - np.eye(3)[r["class"]])) * out * (1 - out)
        want[r.ones] += missed
        shifts += missed
    assert abs(loss - total) < 1e-8 and np.abs(got - want).max() < 1e-10 and np.abs(got_shift - shifts).max() < 1e-9
    monkeypatch.setattr(partial_sums, "MOST_SENT", 0)
    monkeypatch.setattr(wide_perceptron, "BLOCK", 7)
    shuffled = wide_perceptron.evaluate(rows, point, layers)
    assert abs(shuffled[0] - loss) < 1e-8 and np.abs(shuffled[1] - slope).max() < 1e-10


def test_bags_and_subsets(vectors):
    weights = wide_trees._bag(np.arange(50_000), 3, 9)
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.05
    other = wide_trees._bag(np.arange(50_000), 4, 9)
    assert abs(np.corrcoef(weights, other)[0, 1]) < 0.02
    subsets = wide_trees._draw(9, 0, 40, COLUMNS, 8)
    columns = np.arange(COLUMNS)
    sets = [frozenset(columns[subsets.has(np.full(COLUMNS, at), columns)]) for at in range(40)]
    assert {len(s) for s in sets} == {8} and len(set(sets)) > 35


def test_a_null_label_and_other_values_are_refused(spark, vectors):
    none = vectors.withColumn("y", F.when(F.col("k") > 5, F.col("y")))
    with pytest.raises(ValueError, match="null"):
        models.fit_predict_ones(none, vectors, models.tree(3), "y", most_cells=0)
    other = spark.createDataFrame([(1, Vectors.sparse(3, [(0, 2.0)]))], ["k", "features"])
    with pytest.raises(Exception, match="other than 0 and 1"):
        wide_rows.pack(other)


def test_long_lists_are_added_up_in_levels():
    """A perceptron's pass sorted and scanned all ones each time; their order of adding is now laid out once."""
    draw = np.random.default_rng(6)
    source = draw.normal(size=(50, 3))
    for sizes in ([0, 3, 5_000, 1, 0, 33, 32, 64], [0, 0], []):
        sizes = np.array(sizes, np.int64)
        items = draw.integers(0, 50, sizes.sum())
        lists, sums = wide_perceptron._added(wide_perceptron._levels(items, sizes), source)
        ends = np.cumsum(sizes)
        want = {k: source[items[end - n : end]].sum(axis=0) for k, (n, end) in enumerate(zip(sizes, ends)) if n}
        assert sorted(lists) == sorted(want)
        assert all(np.abs(s - want[k]).max() < 1e-9 for k, s in zip(lists, sums))


def test_a_pass_over_few_rows_has_few_tasks(vectors, monkeypatch):
    """Each task sends lines of its own, so many tasks of few rows each take longer than one."""
    rows = wide_rows.pack(vectors.select(F.col("y").alias("c"), "features").filter("c < 4"), label="c")
    assert rows.rdd.getNumPartitions() > 1 and wide_perceptron.blocks(rows).getNumPartitions() == 1
    layers = [COLUMNS, 4, 3, 4]
    point = wide_perceptron.first_weights(layers, 1)
    one = wide_perceptron.evaluate(rows, point, layers)
    monkeypatch.setattr(wide_perceptron, "TASK_ROWS", 1)
    assert wide_perceptron.blocks(rows).getNumPartitions() > 1
    several = wide_perceptron.evaluate(rows, point, layers)
    assert abs(one[0] - several[0]) < 1e-9 and np.abs(one[1] - several[1]).max() < 1e-9


def test_the_direction_of_the_search_is_that_of_two_loops():
    """The products with the steps were taken one by one by a BLAS whose threads kept the next pass waiting."""
    draw, n = np.random.default_rng(8), 9_000
    steps, pairs = wide_perceptron._Steps(n), []
    bend = draw.uniform(0.2, 3.0, n)
    assert np.array_equal(steps.direction(bend), -bend)
    for _ in range(wide_perceptron.MEMORY + 3):
        step = draw.normal(size=n)
        steps.add(step, bend * step)
        pairs = [*pairs, (step, bend * step)][-wide_perceptron.MEMORY :]
    steps.add(step, -step)
    assert len(steps) == wide_perceptron.MEMORY
    slope = draw.normal(size=n)
    want, shares = slope.copy(), []
    for step, change in reversed(pairs):
        shares.append(step @ want / (step @ change))
        want -= shares[-1] * change
    want *= step_scale(*pairs[-1])
    for (step, change), share in zip(pairs, reversed(shares)):
        want += (share - change @ want / (step @ change)) * step
    assert np.abs(steps.direction(slope) + want).max() < 1e-5 * np.abs(want).max()


def step_scale(step, change):
    return (step @ change) / (change @ change)


def test_all_lists_are_counted_in_one_job(spark):
    """Each list column had a job of its own."""
    rows = [(["a", "b", "a", None], ["x"]), (["c"], None), ([], ["x", "y"]), (None, [None])]
    df = spark.createDataFrame(rows, "p array<string>, q array<string>").cache()
    df = df.withColumn("none", F.array().cast("array<string>"))
    assert models._distinct_terms(df, "p", "q", "none") == [3, 2, 1]
    assert models._distinct_terms(df, "q") == [2]


def test_a_long_vocabulary_stays_a_table(spark, monkeypatch):
    """Every feature had a name in the schema and every element one on the driver, which filled its memory."""
    rows = [(1, ["a", "b", "a", None], ["x"]), (2, ["c"], None), (3, [], ["x", "y"]), (4, None, [None]), (5, ["b", "z"], ["y", "x"])]
    df = spark.createDataFrame(rows, "k int, p array<string>, q array<string>").coalesce(1).cache()
    monkeypatch.setattr(models, "MOST_NAMED", 4)
    train = df.filter("k < 5").withColumn("extra", F.lit("kept"))
    encoder = models.multi_hot_vectors(train, ["p", "q"])
    out = encoder.transform(df.withColumn("extra", F.lit("kept")))
    assert out.schema["features"].metadata == {} and out.columns == [*df.columns, "extra", "features"]
    names = {(r.i, r.t): r.feature for r in encoder.vocabulary.collect()}
    assert names == {(0, "a"): 0, (0, "b"): 1, (0, "c"): 2, (1, "x"): 3, (1, "y"): 4}
    for r in out.collect():
        want = [f for (i, t), f in sorted(names.items(), key=lambda x: x[1]) if t in ((r.p, r.q)[i] or [])]
        assert r.features.size == 5 and r.features.indices.tolist() == want and set(r.features.values) <= {1.0}
    assert out.count() == 5 and wide_rows.pack(out.select("k", "features")).count() == 5


def test_a_long_vocabulary_gives_the_vectors_of_spark(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(k, [f"e{min(int(x), 30)}" for x in draw.geometric(0.2, 5)], [f"g{k % 3}"]) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, p array<string>, q array<string>").cache()

    def named(out):
        """How often each feature is one is enough to tell the order; the rows tell the sets."""
        found = {r.k: r.features.indices.tolist() for r in out.select("k", "features").collect()}
        counts = np.bincount(np.concatenate(list(found.values())))
        return sorted(sorted(counts[i] for i in ones) for ones in found.values()), counts

    want = named(models.multi_hot_vectors(df, ["p", "q"]).transform(df))
    monkeypatch.setattr(models, "MOST_NAMED", 3)
    got = named(models.multi_hot_vectors(df, ["p", "q"]).transform(df))
    assert got[0] == want[0] and sorted(got[1]) == sorted(want[1])


def test_the_first_weights_can_be_drawn_in_pieces():
    layers = [50, 4, 3, 5]
    whole = wide_perceptron.first_weights(layers, 7)
    lines = [wide_perceptron.first_lines(layers, 7, begin, min(begin + 13, 50)) for begin in range(0, 50, 13)]
    assert np.array_equal(np.concatenate([*lines, wide_perceptron.first_rest(layers, 7)]), whole)


def test_a_search_whose_weights_are_dealt_out(spark, vectors, monkeypatch):
    """The driver kept some thirty copies of the weights, of which a wide model has millions."""
    train, test = vectors.filter("k % 4 > 0"), vectors
    rows = wide_rows.pack(train.select(F.col("y").alias("c"), "features"), label="c")
    n, classes = rows.count(), int(train.agg(F.max("y")).first()[0]) + 1
    layers = [COLUMNS, 5, 4, classes]
    monkeypatch.setattr(partial_sums, "PART", 35)  # shards of 7 lines
    monkeypatch.setattr(wide_perceptron, "TASK_ROWS", 100)
    monkeypatch.setattr(sharded_perceptron, "MOST_KEPT", 1)
    calls = []
    plain = sharded_perceptron._Search.evaluate

    def watched(self, order):
        found = plain(self, order)
        calls.append((len(pickle.dumps(order)), found[0]))
        return found

    monkeypatch.setattr(sharded_perceptron._Search, "evaluate", watched)
    start = wide_perceptron.evaluate(rows, wide_perceptron.first_weights(layers, 9), layers)[0] / n
    model = sharded_perceptron.fit(rows, layers, 40, 1e-6, 9)
    assert abs(calls[0][1] - start) < 1e-5 and max(size for size, _ in calls) < 1_500
    local = wide_perceptron.fit(rows, layers, 40, 1e-6, 9)
    loss = wide_perceptron.evaluate(rows, local, layers)[0] / n
    assert min(value for _, value in calls) < loss + 0.1
    # the weights that are left are those of the least loss, and predict what they predict on the driver
    states = dict(model.state.collect())
    tried = {key: sharded_perceptron._advanced(sharded_perceptron.Shard(*s), model.order, [])[0].point for key, s in states.items()}
    flat = np.concatenate([tried[key] for key in [*range(1, len(tried)), 0]]).astype(float)
    assert len(tried) == 1 + -(-COLUMNS // 7) and len(flat) == wide_perceptron.size(layers)
    assert abs(wide_perceptron.evaluate(rows, flat, layers)[0] / n - min(v for _, v in calls)) < 1e-4
    tested = wide_rows.pack(test)
    want = {r.k: r.prediction for r in wide_perceptron.predict(tested, flat, layers).collect()}
    got = sharded_perceptron.predict(tested, model)
    assert {r.k: r.prediction for r in got.collect()} == want and got.columns == ["k", "y", "prediction"]
    monkeypatch.setattr(sharded_perceptron, "MOST_LOCAL", 0)
    out = models.fit_predict_ones(train, test, models.perceptron((5,), 25), "y", most_cells=0)
    assert out.count() == N + 1 and len(set(predicted(out).values())) > 2
