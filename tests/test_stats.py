import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmlake.operators.profile import table_profile, value_range
from filmlake.operators.stats import (
    correlation_table,
    histogram,
    line_fits,
    normality,
    omnibus_test,
    r2_score,
    with_line,
)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    y = 0.2 * x + rng.normal(size=300)
    z = np.where(rng.random(300) < 0.2, np.nan, x + rng.normal(size=300))
    data = [(i, float(a), float(b), None if math.isnan(c) else float(c)) for i, (a, b, c) in enumerate(zip(x, y, z))]
    return spark.createDataFrame(data, "id long, x double, y double, z double").repartition(5)


def t_tail(t, df, steps=400_001):
    """Two-sided Student tail by plain numeric integration of the density."""
    angle = np.linspace(0, math.pi / 2, steps)
    density = np.cos(angle) ** (df - 1)
    a0 = math.atan(abs(t) / math.sqrt(df))
    return np.trapezoid(np.where(angle >= a0, density, 0), angle) / np.trapezoid(density, angle)


def test_line_fit(points):
    rows = points.collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    fit = line_fits(points, {"a": ("x", "y"), "b": ("x", "z")}).orderBy("fit").collect()
    slope, intercept = np.polyfit(x, y, 1)
    r = np.corrcoef(x, y)[0, 1]
    assert np.allclose([fit[0].slope, fit[0].intercept, fit[0].r, fit[0].r2], [slope, intercept, r, r * r])
    t = r * math.sqrt(298 / (1 - r * r))
    assert math.isclose(fit[0].p_value, t_tail(t, 298), rel_tol=1e-3)
    assert fit[1].n == sum(row.z is not None for row in rows)


def test_line_fit_p_value_against_table(spark):
    # |t| = 2.2281 is the published 5 % point for 10 degrees of freedom
    r = 2.2281 / math.sqrt(10 + 2.2281**2)
    from filmlake.operators.stats import slope_p_value

    df = spark.createDataFrame([(12, r), (12, 0.0), (2, 1.0), (12, 1.0)], "n long, r double")
    p = [x.p for x in df.select(slope_p_value(F.col("n"), F.col("r")).alias("p")).collect()]
    assert math.isclose(p[0], 0.05, abs_tol=1e-5)
    assert math.isclose(p[1], 1.0) and p[2] is None and p[3] == 0.0


def test_residuals_sum_to_zero(points):
    fitted = with_line(points, "x", "y")
    total, n = fitted.agg(F.sum("residual"), F.count("*")).first()
    assert abs(total) < 1e-9 and n == 300


def test_r2(points):
    score = r2_score(with_line(points, "x", "y"), "y", "prediction").first()
    fit = line_fits(points, {"a": ("x", "y")}, p_value=False).first()
    assert math.isclose(score.r2, fit.r2, rel_tol=1e-9)


def test_correlation_table(points):
    table = {(r.var_a, r.var_b): r["corr"] for r in correlation_table(points, ["x", "y", "z"]).collect()}
    assert len(table) == 9 and all(table[a, a] == 1.0 for a in "xyz")
    assert all(table[a, b] == table[b, a] for a in "xyz" for b in "xyz")
    full = [r for r in points.collect() if r.z is not None]
    complete = {(r.var_a, r.var_b): r["corr"] for r in correlation_table(points, ["x", "y", "z"], True).collect()}
    expected = np.corrcoef([r.x for r in full], [r.y for r in full])[0, 1]
    assert math.isclose(complete["x", "y"], expected, rel_tol=1e-9)
    assert complete["x", "y"] != table["x", "y"]


def test_histogram(spark):
    values = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    bins = histogram(values, "v").orderBy("bin").collect()
    assert [b.n for b in bins] == [1] * 9 + [2]
    assert (bins[0].bin_from, bins[-1].bin_to) == (0.0, 10.0)


def test_histogram_keeps_empty_bins_and_flat_columns(spark):
    gap = histogram(spark.createDataFrame([(0.0,), (10.0,), (None,)], "v double"), "v")
    assert [b.n for b in gap.orderBy("bin").collect()] == [1] + [0] * 8 + [1]
    flat = histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").orderBy("bin").collect()
    assert sum(b.n for b in flat) == 2 and (flat[0].bin_from, flat[-1].bin_to) == (2.5, 3.5)


def test_histogram_counts_sum(points):
    assert histogram(points, "z").agg(F.sum("n")).first()[0] == points.filter("z is not null").count()


def test_normality(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(rng.normal(size=500), rng.exponential(size=500))],
        "a double, b double",
    )
    good, bad = normality(df, "a").first(), normality(df, "b").first()
    assert good.p_value > 0.01 and bad.p_value < 1e-6
    assert math.isclose(good.p_value, math.exp(-good.k2 / 2))
    assert normality(df.limit(5), "a").count() == 0


def test_normality_against_published_example(spark):
    # D'Agostino, Belanger and D'Agostino (1990): 62 cholesterol values
    row = omnibus_test(spark.createDataFrame([(62.0, 1.02, 4.58)], "n double, b1 double, b2 double")).first()
    assert abs(row.z_skew - 3.14) < 0.01 and abs(row.z_kurt - 2.21) < 0.01
    assert abs(row.k2 - 14.75) < 0.05


def test_profile(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, "x")], "a long, b double, c string")
    got = {r.column_name: (r.position, r.data_type, r.non_null, r.n_rows) for r in table_profile(df).collect()}
    assert got == {"a": (0, "bigint", 2, 2), "b": (1, "double", 1, 2), "c": (2, "string", 1, 2)}
    low_high = value_range(df.select("a"), ["a"]).first()
    assert (low_high.min_value, low_high.max_value) == (1.0, 2.0)
