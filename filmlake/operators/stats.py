"""Straight-line fits, correlations, histograms, normality."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LINE_PARTS = ("n", "slope", "intercept", "r", "r2")


def _line(x: Column, y: Column) -> Column:
    return F.struct(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.corr(x, y).alias("r"),
        F.regr_r2(y, x).alias("r2"),
    )


def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    tiny = 1e-300
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    ) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(2000):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / ((1.0 + step * d) or tiny)
        c = (1.0 + step / c) or tiny
        f *= c * d
        if abs(1.0 - c * d) < 1e-15:
            break
    return front * (f - 1.0)


def slope_p_value(n: Column, r: Column) -> Column:
    """Two-sided p-value of a zero slope: Student's t with n - 2 degrees of freedom."""

    def one(count, corr):
        if pd.isna(corr) or count < 3:
            return None
        return _beta_tail((count - 2.0) / 2.0, 0.5, max(0.0, 1.0 - corr * corr))

    @F.pandas_udf("double")
    def p_values(counts: pd.Series, corrs: pd.Series) -> pd.Series:
        return pd.Series([one(*pair) for pair in zip(counts, corrs)], dtype="float64")

    return p_values(n, r)


def line_fits(df: DataFrame, pairs: Mapping[str, tuple[str, str]], p_value: bool = True) -> DataFrame:
    """Least-squares line of y on x per named (x, y) pair.

    All pairs share one aggregation pass; rows missing x or y are left out of that pair.
    Only the finished one-row-per-pair table reaches the p-value helper.
    """
    fits = df.agg(*[_line(F.col(x), F.col(y)).alias(name) for name, (x, y) in pairs.items()])
    rows = fits.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("fit"),
                        *[F.col(f"{name}.{part}").alias(part) for part in LINE_PARTS],
                    )
                    for name in pairs
                ]
            )
        )
    )
    return rows.withColumn("p_value", slope_p_value(F.col("n"), F.col("r"))) if p_value else rows


def with_line(
    df: DataFrame, x: str, y: str, prediction: str = "prediction", residual: str = "residual",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Add the fitted value and the residual of y on x to every row.

    The fit is a scalar subquery: one row of numbers, computed once, no join. ``fit_on`` fits
    the line on other rows than those it is applied to.
    """
    source = df if fit_on is None else fit_on
    fit = source.agg(_line(F.col(x), F.col(y)).alias("line")).scalar()
    fitted = fit["slope"] * F.col(x) + fit["intercept"]
    return df.withColumn(prediction, fitted).withColumn(residual, F.col(y) - F.col(prediction))


def correlation_table(df: DataFrame, columns: Sequence[str], complete_cases: bool = False) -> DataFrame:
    """Correlation matrix in long form (A12 pairwise complete, A13 complete cases).

    Each unordered pair is aggregated once, in a single pass, and mirrored afterwards.
    """
    if complete_cases:
        df = df.dropna("any", subset=list(columns))
    pairs = list(combinations(columns, 2))
    sums = df.agg(
        *[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )

    def cell(a, b, value):
        return F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), value.alias("corr"))

    cells = [cell(c, c, F.when(F.col(f"s{i}") > 0, 1.0)) for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, F.col(f"c{i}")), cell(b, a, F.col(f"c{i}"))]
    return sums.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed.

    Counting is a partial aggregation; empty bins are kept. If all values are equal the range
    is widened by half a unit each side.
    """
    value = F.col(column)
    present = df.select(value.cast("double").alias("v")).filter(value.isNotNull() & ~F.isnan(value))
    lo, hi = F.min("v"), F.max("v")
    span = present.agg(
        F.struct(
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
            F.lit(bins).cast("long").alias("bins"),
        ).alias("s")
    ).scalar()
    bucket = F.least(F.expr("width_bucket(v, s.lo, s.hi, s.bins)"), F.col("s.bins"))
    counts = (
        present.select("v", span.alias("s"))
        .select(bucket.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = (
        df.sparkSession.range(1, bins + 1, numPartitions=1)
        .select(F.col("id").cast("int").alias("bin"), span.alias("s"))
        .select("bin", F.col("s.lo").alias("lo"), ((F.col("s.hi") - F.col("s.lo")) / bins).alias("w"))
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("w")).alias("bin_from"),
        (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def normality(df: DataFrame, column: str) -> DataFrame:
    """D'Agostino-Pearson test of one column as a single row.

    Moments come from one aggregation pass; the rest is arithmetic on that row.
    """
    return omnibus_test(
        df.agg(
            F.count(column).cast("double").alias("n"),
            F.skewness(column).alias("b1"),
            (F.kurtosis(column) + 3).alias("b2"),
        )
    )


def omnibus_test(moments: DataFrame) -> DataFrame:
    """The same test for rows of count ``n``, skewness ``b1`` and kurtosis ``b2``.

    Formulas of D'Agostino (1970) and Anscombe and Glynn (1983); fewer than 8 values give no row.
    """
    n, b1, b2 = F.col("n"), F.col("b1"), F.col("b2")
    y = b1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = (
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
        / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(2 * (beta - 1)) - 1
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.log(w2) / 2)
    x = (b2 - 3 * (n - 1) / (n + 1)) / F.sqrt(
        24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    )
    g = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / g * (2 / g + F.sqrt(1 + 4 / (g * g)))
    d = 1 + x * F.sqrt(2 / (a - 4))
    z2 = ((1 - 2 / (9 * a)) - F.signum(d) * F.cbrt((1 - 2 / a) / F.abs(d))) / F.sqrt(2 / (9 * a))
    return (
        moments.filter(n >= 8)
        .select(n.cast("long").alias("n"), b1.alias("skew"), b2.alias("kurt"), z1.alias("z_skew"), z2.alias("z_kurt"))
        .withColumn("k2", F.col("z_skew") * F.col("z_skew") + F.col("z_kurt") * F.col("z_kurt"))
        .withColumn("p_value", F.exp(-F.col("k2") / 2))
    )


def r2_score(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """1 - SSE / SST on the given rows, in one pass."""
    y, p = F.col(truth), F.col(prediction)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), F.regr_syy(y, y))).alias("r2"),
    )
