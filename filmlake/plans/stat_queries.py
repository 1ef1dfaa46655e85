"""Fits, correlations, histograms and normality of ratings and money."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import iso_epoch, iso_year
from ..operators.joins import complete, join_chain, well_rated
from ..operators.metrics import exact_accuracy, tolerance_accuracy
from ..operators.models import in_train
from ..operators.stats import (
    correlation_table,
    histogram,
    line_fits,
    normality,
    r2_score,
    with_line,
)
from ..session import materialize
from . import views as v
from .table_queries import MONEY_CTE, real_money
from .views import FILMS_CTE, PLOTS_CTE, with_ctes

RATING_COLUMNS = ["audience_average", "audience_percent", "critic_average", "critic_percent"]
PAIRS = {
    "profit_on_audience": ("audience_percent", "profit"),
    "profit_on_critic": ("critic_percent", "profit"),
    "audience_on_critic": ("critic_percent", "audience_percent"),
    "critic_on_audience": ("audience_percent", "critic_percent"),
    "critic_avg_on_audience_avg": ("audience_average", "critic_average"),
    "profit_rate_on_year": ("year", "profit_rate"),
}
YEAR_PAIRS = {c: ("year", c) for c in RATING_COLUMNS}


def _rounded(fits):
    return fits.select(
        "fit", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"),
        F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"),
        F.round("p_value", 6).alias("p_value"),
    )


def _sql_fit(pairs: dict, source: str) -> str:
    """Fits by centred sums; the p-value by Simpson's rule over the density of the angle
    atan(t / sqrt(df)), which is proportional to cos(angle) ** (df - 1)."""
    cells = " UNION ALL ".join(
        f"""
  SELECT '{name}' AS fit, count(*) AS n, avg(CAST({x} AS DOUBLE)) AS mx, avg({y}) AS my,
    covar_pop({y}, {x}) AS cxy, var_pop(CAST({x} AS DOUBLE)) AS vx, var_pop({y}) AS vy
  FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""
        for name, (x, y) in pairs.items()
    )
    return f"""
sums AS ({cells}
),
fits AS (
  SELECT fit, n, cxy / vx AS slope, my - cxy / vx * mx AS intercept, cxy / sqrt(vx * vy) AS r
  FROM sums
),
grid AS (SELECT i, CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
  FROM range(20001) t(i)),
tails AS (
  SELECT fit, asin(least(abs(r), 1.0)) AS a0, n - 3.0 AS e FROM fits
),
areas AS (
  SELECT fit,
    sum(w * pow(cos(least(a0 + (pi() / 2 - a0) * i / 20000, pi() / 2)), e)) * (pi() / 2 - a0) AS tail,
    sum(w * pow(cos(least(pi() / 2 * i / 20000, pi() / 2)), e)) * (pi() / 2) AS whole
  FROM tails CROSS JOIN grid GROUP BY fit, a0
)"""


_FIT_SELECT = """
SELECT fit, n, round(slope, 4) AS slope, round(intercept, 3) AS intercept, round(r, 6) AS r,
  round(r * r, 6) AS r2, round(tail / whole, 6) AS p_value
FROM fits JOIN areas USING (fit)"""


def linfit_table(spark, sf_dir):
    return _rounded(line_fits(real_money(spark, sf_dir), PAIRS))


LINFIT_SQL = with_ctes(MONEY_CTE, _sql_fit(PAIRS, "money"), select=_FIT_SELECT)


def _narrow_money(spark, sf_dir, *columns):
    """The few columns a fit and its residuals read, written once so that the joins below run once."""
    return materialize(real_money(spark, sf_dir).select("film_key", *columns), "money")


def _residuals(spark, sf_dir):
    narrow = _narrow_money(spark, sf_dir, "critic_percent", "audience_percent")
    return with_line(narrow, "critic_percent", "audience_percent")


def linfit_residuals(spark, sf_dir):
    return _residuals(spark, sf_dir).select(
        "film_key", F.round("prediction", 6).alias("prediction"), F.round("residual", 6).alias("residual")
    )


RESIDUAL_CTE = """
line AS (
  SELECT covar_pop(audience_percent, critic_percent) / var_pop(critic_percent) AS b,
    avg(audience_percent) AS my, avg(critic_percent) AS mx FROM money
),
resid AS (
  SELECT film_key, my + b * (critic_percent - mx) AS prediction,
    audience_percent - (my + b * (critic_percent - mx)) AS residual FROM money, line
)"""
RESIDUALS_SQL = with_ctes(
    MONEY_CTE,
    RESIDUAL_CTE,
    select="SELECT film_key, round(prediction, 6) AS prediction, round(residual, 6) AS residual FROM resid",
)


def corr_pairwise(spark, sf_dir):
    c = correlation_table(v.ratings(spark, sf_dir), RATING_COLUMNS)
    return c.select("var_a", "var_b", F.round("corr", 6).alias("corr"))


def corr_complete(spark, sf_dir):
    c = correlation_table(
        v.ratings(spark, sf_dir), RATING_COLUMNS + ["audience_ratings"], complete_cases=True
    )
    return c.select("var_a", "var_b", F.round("corr", 6).alias("corr"))


def _sql_corr(columns, where="true") -> str:
    return with_ctes(
        FILMS_CTE,
        select=" UNION ALL ".join(
            f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS corr FROM ratings WHERE {where}"
            for a in columns
            for b in columns
        ),
    )


CORR_PAIRWISE_SQL = _sql_corr(RATING_COLUMNS)
CORR_COMPLETE_SQL = _sql_corr(
    RATING_COLUMNS + ["audience_ratings"], "critic_average IS NOT NULL AND critic_percent IS NOT NULL"
)


def residual_histogram(spark, sf_dir):
    """Histogram of the review residual, rounded so that no value sits on a bin edge by noise."""
    rounded = _residuals(spark, sf_dir).withColumn("residual", F.round("residual", 6))
    return histogram(rounded, "residual").select(
        "bin", F.round("bin_from", 4).alias("bin_from"), F.round("bin_to", 4).alias("bin_to"), "n"
    )


HISTOGRAM_SQL = with_ctes(
    MONEY_CTE,
    RESIDUAL_CTE,
    """
rounded AS (SELECT round(residual, 6) AS v FROM resid),
span AS (SELECT min(v) AS lo, max(v) AS hi FROM rounded),
binned AS (
  SELECT least(CAST(floor((v - lo) / (hi - lo) * 10) AS INTEGER) + 1, 10) AS bin, count(*) AS n
  FROM rounded, span GROUP BY 1
)""",
    select="""
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * (hi - lo) / 10, 4) AS bin_from,
  round(lo + i * (hi - lo) / 10, 4) AS bin_to, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM range(1, 11) t(i) CROSS JOIN span LEFT JOIN binned ON binned.bin = i""",
)


def residual_normality(spark, sf_dir):
    t = normality(_residuals(spark, sf_dir), "residual")
    return t.select(
        "n", *[F.round(c, 5).alias(c) for c in ("skew", "kurt", "z_skew", "z_kurt")],
        F.round("k2", 3).alias("k2"), F.round("p_value", 6).alias("p_value"),
    )


NORMALITY_SQL = with_ctes(
    MONEY_CTE,
    RESIDUAL_CTE,
    """
mean AS (SELECT avg(residual) AS m FROM resid),
sums AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, avg(pow(residual - m, 2)) AS m2,
    avg(pow(residual - m, 3)) AS m3, avg(pow(residual - m, 4)) AS m4 FROM resid, mean
),
a AS (SELECT n, m3 / pow(m2, 1.5) AS b1, m4 / (m2 * m2) AS b2 FROM sums),
b AS (
  SELECT *, b1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
    3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
    (b2 - 3 * (n - 1) / (n + 1))
      / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x,
    6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
      * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS g FROM a
),
c AS (
  SELECT *, sqrt(2 * (beta - 1)) - 1 AS w2,
    6 + 8 / g * (2 / g + sqrt(1 + 4 / (g * g))) AS aa FROM b
),
d AS (
  SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) AS z1,
    1 + x * sqrt(2 / (aa - 4)) AS dd FROM c
),
e AS (
  SELECT *, ((1 - 2 / (9 * aa)) - sign(dd) * cbrt((1 - 2 / aa) / abs(dd))) / sqrt(2 / (9 * aa)) AS z2
  FROM d
)""",
    select="""
SELECT CAST(n AS BIGINT) AS n, round(b1, 5) AS skew, round(b2, 5) AS kurt, round(z1, 5) AS z_skew,
  round(z2, 5) AS z_kurt, round(z1 * z1 + z2 * z2, 3) AS k2,
  round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p_value FROM e""",
)


def _dated_chain(spark, sf_dir):
    sums = v.written_sums(spark, sf_dir)
    chain = join_chain(
        v.films(spark, sf_dir, sums),
        v.ratings(spark, sf_dir, sums).drop("film_key"),
        v.plots(spark, sf_dir).select("imdb_id", F.col("film").alias("plot_key")),
    )
    rated = complete(well_rated(chain), ["publication_date", *RATING_COLUMNS])
    return rated.withColumn("year", iso_year(F.col("publication_date"))).withColumn(
        "timestamp", iso_epoch(F.col("publication_date"))
    )


YEAR_CTE = f"""{FILMS_CTE},{PLOTS_CTE},
dated AS (
  SELECT f.film_key, CAST(substr(f.publication_date, 1, 4) AS INTEGER) AS year,
    CAST(epoch(CAST(f.publication_date AS DATE)) AS BIGINT) AS timestamp,
    r.audience_average, r.audience_percent, r.critic_average, r.critic_percent
  FROM films f JOIN ratings r ON f.rotten_tomatoes_id = r.rotten_tomatoes_id
  JOIN plots p ON f.imdb_id = p.imdb_id
  WHERE r.audience_ratings >= 40 AND r.critic_average IS NOT NULL AND r.critic_percent IS NOT NULL
)"""


def year_trend(spark, sf_dir):
    return _rounded(line_fits(_dated_chain(spark, sf_dir), YEAR_PAIRS))


YEAR_TREND_SQL = with_ctes(YEAR_CTE, _sql_fit(YEAR_PAIRS, "dated"), select=_FIT_SELECT)


def year_epochs(spark, sf_dir):
    return _dated_chain(spark, sf_dir).select("film_key", "year", "timestamp")


YEAR_EPOCHS_SQL = with_ctes(YEAR_CTE, select="SELECT film_key, year, timestamp FROM dated")


def trend_outlier_cut(spark, sf_dir):
    """Year trend of the profit rate fitted on all films, applied to those below the cut."""
    money = _narrow_money(spark, sf_dir, "year", "profit_rate")
    kept = money.filter(F.col("profit_rate") < 500)
    return with_line(kept, "year", "profit_rate", fit_on=money).select(
        "film_key", "year", F.round("prediction", 6).alias("prediction")
    )


TREND_CUT_SQL = with_ctes(
    MONEY_CTE,
    """
line AS (
  SELECT covar_pop(profit_rate, CAST(year AS DOUBLE)) / var_pop(CAST(year AS DOUBLE)) AS b,
    avg(profit_rate) AS my, avg(CAST(year AS DOUBLE)) AS mx FROM money
  WHERE profit_rate IS NOT NULL
)""",
    select="SELECT film_key, year, round(my + b * (year - mx), 6) AS prediction FROM money, line WHERE profit_rate < 500",
)


def _ols(spark, sf_dir):
    """Line of critic on audience average fitted on the training films, applied to the others."""
    rated = _narrow_money(spark, sf_dir, "audience_average", "critic_average")
    train, test = in_train(F.col("film_key")), ~in_train(F.col("film_key"))
    return with_line(
        rated.filter(test), "audience_average", "critic_average", fit_on=rated.filter(train)
    )


OLS_CTE = (
    MONEY_CTE
    + """,
parts AS (SELECT *, substr(md5(CAST(film_key AS VARCHAR)), 1, 8) < 'c0000000' AS train FROM money),
line AS (
  SELECT covar_pop(critic_average, audience_average) / var_pop(audience_average) AS b,
    avg(critic_average) AS my, avg(audience_average) AS mx FROM parts WHERE train
),
tested AS (
  SELECT film_key, critic_average, my + b * (audience_average - mx) AS prediction
  FROM parts, line WHERE NOT train
)"""
)


def ols_r2(spark, sf_dir):
    r2 = r2_score(_ols(spark, sf_dir), "critic_average", "prediction")
    return r2.select("n", F.round("r2", 6).alias("r2"))


OLS_R2_SQL = with_ctes(
    OLS_CTE,
    "\nmean AS (SELECT avg(critic_average) AS m FROM tested)",
    select="""
SELECT count(*) AS n, round(1 - sum(pow(critic_average - prediction, 2))
  / sum(pow(critic_average - m, 2)), 6) AS r2 FROM tested, mean""",
)


def tolerance_share(spark, sf_dir):
    t = tolerance_accuracy(
        _ols(spark, sf_dir).withColumn("prediction", F.round("prediction", 6)),
        "critic_average", "prediction", 1.0,
    )
    return t.select("n", F.round("accuracy", 6).alias("accuracy"))


TOLERANCE_SQL = with_ctes(
    OLS_CTE,
    select="SELECT count(*) AS n, round(avg(CASE WHEN abs(critic_average - round(prediction, 6)) <= 1.0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM tested",
)


def truncated_accuracy(spark, sf_dir):
    """Exact accuracy after both sides are rescaled to 0-100 and truncated to whole numbers."""
    scaled = _ols(spark, sf_dir).select(
        (F.col("critic_average") * 10).cast("int").alias("truth"),
        (F.round("prediction", 6) * 10).cast("int").alias("guess"),
    )
    return exact_accuracy(scaled, "truth", "guess").select("n", F.round("accuracy", 6).alias("accuracy"))


TRUNCATED_SQL = with_ctes(
    OLS_CTE,
    select="""
SELECT count(*) AS n, round(avg(CASE WHEN trunc(critic_average * 10) = trunc(round(prediction, 6) * 10)
  THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM tested""",
)


def split_hash(spark, sf_dir):
    films = v.films(spark, sf_dir).select("film_key", in_train(F.col("film_key")).alias("train"))
    return films.groupBy("train").agg(
        F.count(F.lit(1)).alias("n"), F.sum("film_key").cast("long").alias("key_sum")
    )


SPLIT_SQL = """
SELECT substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'c0000000' AS train, count(*) AS n,
  CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1"""

QUERIES = {
    "linfit_table": (linfit_table, LINFIT_SQL),
    "linfit_residuals": (linfit_residuals, RESIDUALS_SQL),
    "corr_pairwise": (corr_pairwise, CORR_PAIRWISE_SQL),
    "corr_complete": (corr_complete, CORR_COMPLETE_SQL),
    "residual_histogram": (residual_histogram, HISTOGRAM_SQL),
    "residual_normality": (residual_normality, NORMALITY_SQL),
    "year_trend": (year_trend, YEAR_TREND_SQL),
    "year_epochs": (year_epochs, YEAR_EPOCHS_SQL),
    "trend_outlier_cut": (trend_outlier_cut, TREND_CUT_SQL),
    "ols_r2": (ols_r2, OLS_R2_SQL),
    "tolerance_accuracy": (tolerance_share, TOLERANCE_SQL),
    "exact_accuracy": (truncated_accuracy, TRUNCATED_SQL),
    "split_hash": (split_hash, SPLIT_SQL),
}
