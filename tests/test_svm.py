"""The pairwise linear support vector machine against exact solutions and its own certificate."""

import itertools

import numpy as np
import pytest

from filmlake.operators import svm

COST = 2.0


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x array<double>, y int").repartition(3)


def objective(x, sign, w, b):
    return 0.5 * w @ w + COST * np.maximum(0, 1 - sign * (x @ w + b)).sum()


def exact(x, sign):
    """The least objective and its plane: the best of all points where enough hinges are at 0.

    The problem is a quadratic programme, so its optimum solves the equations of the rows that
    lie on the margin; all small sets of such rows, and all sides of the others, are tried.
    """
    n, d = x.shape
    best = (np.inf, None)
    for size in range(0, d + 2):
        for on in map(list, itertools.combinations(range(n), size)):
            rest = [i for i in range(n) if i not in on]
            for inside in itertools.product([0, 1], repeat=len(rest)):
                pull = sum((COST * s * sign[i] * x[i] for s, i in zip(inside, rest)), np.zeros(d))
                push = sum(COST * s * sign[i] for s, i in zip(inside, rest))
                # unknown: w, b, duals of the rows on the margin
                a = np.zeros((d + 1 + size, d + 1 + size))
                r = np.zeros(d + 1 + size)
                a[:d, :d], r[:d] = np.eye(d), pull
                r[d] = -push
                for k, i in enumerate(on):
                    a[:d, d + 1 + k] = -sign[i] * x[i]
                    a[d, d + 1 + k] = sign[i]
                    a[d + 1 + k, :d], a[d + 1 + k, d], r[d + 1 + k] = sign[i] * x[i], sign[i], 1
                found = np.linalg.lstsq(a, r, rcond=None)[0]
                value = objective(x, sign, found[:d], found[d])
                if value < best[0] - 1e-12:
                    best = (value, (found[:d], found[d]))
    return best


def test_margins_match_exact_solutions(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=2) + [0.8 * (i % 3), 0.4 * (i % 3)]).tolist(), [4, 9, 30][i % 3]) for i in range(12)]
    planes = svm.fit(frame(spark, rows), "x", "y", [4, 9, 30], COST, tolerance=1e-5)
    assert (planes.gaps <= 1e-5 * planes.objectives).all()
    for at, (a, b) in enumerate(zip(planes.first, planes.second)):
        chosen = [(x, 1.0 if y == planes.classes[a] else -1.0) for _, x, y in rows if y in (planes.classes[a], planes.classes[b])]
        x, sign = np.array([c[0] for c in chosen]), np.array([c[1] for c in chosen])
        value, (w, shift) = exact(x, sign)
        assert planes.objectives[at] == pytest.approx(value, rel=1e-5)
        assert np.allclose(planes.weights[at], w, atol=1e-2)
        if 0 < sum(np.isclose(sign * (x @ w + shift), 1, atol=1e-6)):
            assert np.allclose(x @ planes.weights[at] + planes.intercepts[at], x @ w + shift, atol=2e-2)


def test_gaps_are_small_and_true_on_overlapping_classes(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=3) + 0.4 * (i % 5)).tolist(), i % 5) for i in range(400)]
    planes = svm.fit(frame(spark, rows), "x", "y", list(range(5)), COST)
    assert (planes.gaps <= 1e-3 * planes.objectives).all() and (planes.gaps > -1e-9).all()
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for at, (a, b) in enumerate(zip(planes.first, planes.second)):
        here = (y == a) | (y == b)
        sign = np.where(y[here] == a, 1.0, -1.0)
        w, shift = planes.weights[at], planes.intercepts[at]
        value = objective(x[here], sign, w, shift)
        assert value == pytest.approx(planes.objectives[at])
        # nowhere around is the objective lower by more than the gap
        for _ in range(50):
            near = objective(x[here], sign, w + 0.1 * draw.normal(size=3), shift + 0.1 * draw.normal())
            assert near >= value - planes.gaps[at] - 1e-9


def test_partitions_change_nothing(spark):
    draw = np.random.default_rng(7)
    rows = [(i, draw.normal(size=2).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int")
    one, many = (svm.fit(df.repartition(n), "x", "y", [0, 1]) for n in (1, 7))
    assert np.allclose(one.weights, many.weights) and np.allclose(one.intercepts, many.intercepts)


def test_rows_without_label_or_features_and_a_hot_class(spark):
    rows = [(i, [float(i % 7), 1.0], 1) for i in range(300)]
    rows += [(1000 + i, [-3.0 - i, 1.0], 2) for i in range(4)]
    rows += [(2000, None, 1), (2001, [5.0, 1.0], None), (2002, [9.0, 1.0], 77)]
    df = frame(spark, rows)
    planes = svm.fit(df, "x", "y", [1, 2])
    got = {r.id: r.predicted for r in svm.votes(df, planes, "x").collect()}
    assert len(got) == len(rows) and got[2000] is None
    assert all(got[i] == y for i, x, y in rows if i < 2000) and got[2001] == 1


def test_votes_and_ties(spark):
    first, second, _, _ = svm._pairs(3)
    weights = np.array([[1.0], [-1.0], [1.0]])  # 0 beats 1, 2 beats 0, 1 beats 2 for x > 0
    planes = svm.Planes([5, 6, 7], first, second, weights, np.zeros(3), np.zeros(3), np.zeros(3))
    df = frame(spark, [(1, [2.0], 0), (2, None, 0)])
    got = {r.id: r.predicted for r in svm.votes(df, planes, "x").collect()}
    assert got == {1: 5, 2: None}


def test_no_rows_one_class_and_too_many_numbers(spark, monkeypatch):
    df = frame(spark, [(1, [2.0], 3)])
    one = svm.votes(df, svm.fit(df, "x", "y", [3]), "x")
    assert [r.predicted for r in one.collect()] == [3]
    none = svm.fit(df.limit(0), "x", "y", [])
    assert svm.votes(df, none, "x").first().predicted is None
    monkeypatch.setattr(svm, "MOST_NUMBERS", 3)
    with pytest.raises(ValueError, match="too many"):
        svm.fit(df, "x", "y", [3, 4])


def test_votes_equal_sql_over_the_planes(spark):
    """The predictions again, by SQL from the fitted planes."""
    import duckdb
    import pandas as pd

    draw = np.random.default_rng(11)
    rows = [(i, draw.normal(size=2).round(3).tolist(), int(draw.integers(0, 4))) for i in range(120)]
    first, second, _, _ = svm._pairs(4)
    weights, shifts = draw.normal(size=(6, 2)).round(3), draw.normal(size=6).round(3)
    planes = svm.Planes([10, 20, 30, 40], first, second, weights, shifts, np.zeros(6), np.zeros(6))
    got = {r.id: r.predicted for r in svm.votes(frame(spark, rows), planes, "x").collect()}
    points = pd.DataFrame([(i, *x) for i, x, _ in rows], columns=["id", "x0", "x1"])  # noqa: F841
    table = pd.DataFrame(  # noqa: F841
        {"a": 10 * (first + 1), "b": 10 * (second + 1), "w0": weights[:, 0], "w1": weights[:, 1], "s": shifts}
    )
    want = duckdb.sql("""
        WITH won AS (
          SELECT id, CASE WHEN x0 * w0 + x1 * w1 + s > 0 THEN a ELSE b END AS c FROM points CROSS JOIN "table"
        ), counted AS (SELECT id, c, count(*) AS n FROM won GROUP BY id, c)
        SELECT id, c FROM counted QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, c) = 1
    """).fetchall()
    assert got == dict(want)
