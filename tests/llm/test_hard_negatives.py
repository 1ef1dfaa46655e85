import numpy as np
import pytest
from pyspark.sql import functions as F

from filmlake.llm import hard_negatives as hard


def brute(rows, every=50, positives=5, negatives=3):
    """All products of all anchors, sorted."""
    taken = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(x))) for x in v]
        taken.append((vec_id, whole, (label + 1) % 10 if vec_id % 7 == 0 else label))
    found = []
    for a, (anchor, v, label) in enumerate(taken):
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, k) for k, (i, w, _) in enumerate(taken) if k != a]
        same = sorted(s for s in scores if taken[s[2]][2] == label)[:positives]
        other = sorted(s for s in scores if taken[s[2]][2] != label)
        for p, positive, _ in same:
            inside = [s for s in other if 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            found += [(anchor, positive, k, i, -p, -n) for k, (n, i, _) in enumerate(inside, 1)]
    return found


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, k, 7) for i, v, k in rows], "vec_id long, embedding array<double>, label int, row int"
    )


def made(n=700, width=7, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width))
    rows = []
    for i in range(n):
        rows.append((i, (centres[i % 6] + 0.6 * draw.normal(size=width)).tolist(), int(draw.integers(0, 4))))
    same = rows[5][1]
    rows += [(2000 + i, same, i % 3) for i in range(260)]
    rows += [(50, rows[50][1], 1), (50, rows[50][1], 1), (7, rows[9][1], 2)]
    rows += [(900, None, 1), (901, [1.0], None), (902, [None] * width, 1), (903, [float("nan")] * width, 1)]
    rows += [(904, [float("inf")] + [0.0] * (width - 1), 1), (None, same, 1), (950, [], 2), (1000, [0.0] * width, 3)]
    return rows + [(1050, [1.0, -1.0], 3), (1100, [-x for x in same], 0)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, rows, monkeypatch, small):
    if small:
        for name, value in {"SLICE_ROWS": 40, "QUERY_ROWS": 5, "SCORES_AT_ONCE": 200, "FIRST_ROWS": 20, "CELL_ROWS": 4}.items():
            monkeypatch.setattr(hard, name, value)
    data = made()
    got = hard.mine(hard.vectors(frame(spark, data).repartition(4)), fit_rows=200)
    want = brute(data)
    assert rows(got) == sorted(want, key=lambda t: tuple(map(str, t))) and len(want) > 100


def test_large_components_stay_exact(spark, rows):
    draw = np.random.default_rng(2)
    data = [(25 * i, (draw.normal(size=4) * 1e5 + 3e5).tolist(), i % 2) for i in range(40)]
    got = hard.mine(hard.vectors(frame(spark, data)))
    assert rows(got) == sorted(brute(data), key=lambda t: tuple(map(str, t)))
    with pytest.raises(ValueError, match="63 bits"):
        hard.mine(hard.vectors(frame(spark, [(0, [1e8] * 4, 1), (50, [1e8] * 4, 1)])))


def test_no_rows_and_no_anchors(spark):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for data in ([], [(1, [1.0], 1)], [(50, [1.0], 1)], [(50, [], 1)]):
        got = hard.mine(hard.vectors(frame(spark, data)))
        assert got.columns == columns and not got.count()


def test_cells_are_visited_by_falling_bounds_that_hold(spark):
    draw = np.random.default_rng(4)
    data = frame(spark, [(i, draw.normal(size=6).tolist(), 0) for i in range(600)])
    index, cells = hard.build_index(hard.vectors(data), 6, fit_rows=100)
    rows = cells.toPandas()
    assert index.counts.sum() == 600
    for query in draw.normal(size=(20, 6)) * 300:
        visited = list(index.visit(query))
        bounds = [b for b, _, _ in visited]
        assert bounds == sorted(bounds, reverse=True)
        assert len({(i, j) for _, i, j in visited}) == len(visited) == index.counts.size
        limit = {(i, j): b for b, i, j in visited}
        for v, i, j in zip(rows.v, rows.i, rows.j):
            assert np.dot(query, v) <= limit[(i, j)]


def test_few_cells_are_visited_where_vectors_lie_apart(spark):
    """The certificate stops the search: queries do not meet every cell."""
    draw = np.random.default_rng(6)
    centres = np.kron(np.eye(4), np.ones(2)) * 20
    rows = [(i, (centres[i % 4] + 0.1 * draw.normal(size=8)).tolist(), i % 2) for i in range(4000)]
    index, cells = hard.build_index(hard.vectors(frame(spark, rows)), 8)
    asked = cells.filter("vec_id % 50 = 0").select(
        "row", "label", "v", F.lit(0).alias("pops"), F.lit(1.0e7).alias("stop"), F.lit(1 << 62).alias("least")
    )
    met = hard._visits(asked, index, 8).select(F.sum(F.size("js")).alias("n")).first().n
    assert met < 0.5 * asked.count() * (index.counts > 0).sum()
