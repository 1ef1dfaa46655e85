"""Classifiers of ratings, success and genres."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.dates import iso_year
from ..functions.lists import as_list, first_n
from ..functions.money import money_value, profit
from ..functions.text import clean_text, clean_tokens, without_words
from ..operators import models as m
from ..operators import multilabel as ml
from ..operators import svm
from ..operators.bayes import fit_multinomial, predict_multinomial
from ..operators.joins import complete, well_rated
from ..operators.knn import knn_predict, nearest_neighbours, standardise
from ..operators.metrics import micro_f1_sets, tolerance_accuracy
from ..operators.rare import remove_rare
from ..operators.tfidf import (
    anova_f,
    f_ceiling,
    fit_vocabulary,
    list_sums,
    select_share,
    term_counts,
    weighted_terms,
)
from ..session import materialize
from . import views as v
from .list_queries import kept_films
from .table_queries import film_chain
from .views import FILMS_CTE, STOP_WORDS, with_ctes

FEATURES = ["audience_percent", "critic_average", "critic_percent"]
SUCCESS_LISTS = ["director", "cast_member", "genre", "company"]


def _rated(spark, sf_dir):
    """(film_key, three standardised features on 0-100, whole-number label), split by key."""
    rated = complete(well_rated(v.ratings(spark, sf_dir)), ["critic_average", "critic_percent"])
    scaled = rated.select(
        "film_key", "audience_percent", (F.col("critic_average") * 10).alias("critic_average"),
        "critic_percent", (F.col("audience_average") * 20).cast("int").alias("label"),
        m.in_train(F.col("film_key")).alias("train"),
    )
    return materialize(scaled, "rated")


def _standard(spark, sf_dir):
    rated = _rated(spark, sf_dir)
    scaled = standardise(rated, FEATURES, fit_on=rated.filter("train"))
    return scaled.filter("train"), scaled.filter(~F.col("train"))


RATED_CTE = f"""{FILMS_CTE},
rated AS (
  SELECT film_key, audience_percent AS a, critic_average * 10 AS b, critic_percent AS c,
    CAST(trunc(audience_average * 20) AS INTEGER) AS label,
    substr(md5(CAST(film_key AS VARCHAR)), 1, 8) < 'c0000000' AS train
  FROM ratings WHERE audience_ratings >= 40 AND critic_average IS NOT NULL AND critic_percent IS NOT NULL
),
mom AS (
  SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
    stddev_pop(c) AS sc FROM rated WHERE train
),
std AS (
  SELECT film_key, train, label, (a - ma) / sa AS a, (b - mb) / sb AS b, (c - mc) / sc AS c
  FROM rated, mom
),
pairs AS (
  SELECT q.film_key, t.film_key AS neighbour, t.label,
    round(pow(q.a - t.a, 2) + pow(q.b - t.b, 2) + pow(q.c - t.c, 2), 9) AS d2
  FROM std q JOIN std t ON NOT q.train AND t.train
),
near AS (
  SELECT *, row_number() OVER (PARTITION BY film_key ORDER BY d2, neighbour) AS rank FROM pairs
  QUALIFY rank <= 10
)"""


def standardised(spark, sf_dir):
    train, test = _standard(spark, sf_dir)
    both = train.unionByName(test)
    return both.select("film_key", "train", "label", *[F.round(c, 6).alias(c) for c in FEATURES])


STANDARD_SQL = with_ctes(
    RATED_CTE,
    select="""
SELECT film_key, train, label, round(a, 6) AS audience_percent, round(b, 6) AS critic_average,
  round(c, 6) AS critic_percent FROM std""",
)


def knn_neighbours(spark, sf_dir):
    train, test = _standard(spark, sf_dir)
    near = nearest_neighbours(test, train, "film_key", "label", FEATURES, 10)
    return near.select("film_key", "rank", "neighbour", "label", F.round("d2", 6).alias("d2"))


def knn_vote(spark, sf_dir):
    train, test = _standard(spark, sf_dir)
    return knn_predict(test, train, "film_key", "label", FEATURES, 10)


KNN_SQL = with_ctes(
    RATED_CTE,
    select="SELECT film_key, CAST(rank AS INTEGER) AS rank, neighbour, label, round(d2, 6) AS d2 FROM near",
)
KNN_VOTE_SQL = with_ctes(
    RATED_CTE,
    "\nvotes AS (SELECT film_key, label, count(*) AS votes FROM near GROUP BY film_key, label)",
    select="""
SELECT film_key, label AS prediction, votes FROM votes
QUALIFY row_number() OVER (PARTITION BY film_key ORDER BY votes DESC, label) = 1""",
)


def _vectors(df, columns=FEATURES):
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def gaussian_bayes(spark, sf_dir):
    train, test = _standard(spark, sf_dir)
    out = m.fit_predict(_vectors(train), _vectors(test), m.gaussian_bayes(), "label")
    return out.select("film_key", "label", F.col("predicted").cast("int").alias("predicted"))


GAUSSIAN_CTE = RATED_CTE + """,
cls AS (
  SELECT label, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
    var_pop(a) + 1e-9 AS va, var_pop(b) + 1e-9 AS vb, var_pop(c) + 1e-9 AS vc
  FROM std WHERE train GROUP BY label
),
scored AS (
  SELECT q.film_key, q.label, k.label AS predicted, ln(k.n)
    - 0.5 * (ln(va) + ln(vb) + ln(vc)) - pow(q.a - ma, 2) / (2 * va)
    - pow(q.b - mb, 2) / (2 * vb) - pow(q.c - mc, 2) / (2 * vc) AS score
  FROM std q CROSS JOIN cls k WHERE NOT q.train
),
gaussian AS (
  SELECT film_key, label, predicted FROM scored
  QUALIFY row_number() OVER (PARTITION BY film_key ORDER BY round(score, 7) DESC, predicted) = 1
)"""
GAUSSIAN_SQL = with_ctes(GAUSSIAN_CTE, select="SELECT film_key, label, predicted FROM gaussian")


def linear_svm(spark, sf_dir):
    """Votes of the planes between all pairs of labels, C = 2."""
    train, test = (df.withColumn("x", F.array(*FEATURES)) for df in _standard(spark, sf_dir))
    planes = svm.fit(train, "x", "label", m.class_values(train, "label"))
    return svm.votes(test, planes, "x").select("film_key", "label", "predicted")


def _within_four(predicted, prediction):
    """Share of test films predicted within four points."""
    share = tolerance_accuracy(predicted, "label", prediction, 4)
    return share.select("n", F.round("accuracy", 6).alias("accuracy"))


def gaussian_accuracy(spark, sf_dir):
    return _within_four(gaussian_bayes(spark, sf_dir), "predicted")


def knn_accuracy(spark, sf_dir):
    train, test = _standard(spark, sf_dir)
    votes = knn_predict(test, train, "film_key", "label", FEATURES, 10)
    return _within_four(test.select("film_key", "label").join(votes, "film_key", "left"), "prediction")


def svm_accuracy(spark, sf_dir):
    return _within_four(linear_svm(spark, sf_dir), "predicted")


def _sql_within_four(predictions):
    return f"""
SELECT count(*) AS n, round(avg(CASE WHEN abs(s.label - p.predicted) <= 4 THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
FROM std s JOIN ({predictions}) p ON s.film_key = p.film_key"""


GAUSSIAN_ACCURACY_SQL = with_ctes(
    GAUSSIAN_CTE, select=_sql_within_four("SELECT film_key, predicted FROM gaussian")
)
KNN_ACCURACY_SQL = with_ctes(
    RATED_CTE,
    "\nvotes AS (SELECT film_key, label, count(*) AS votes FROM near GROUP BY film_key, label)",
    select=_sql_within_four("""
  SELECT film_key, label AS predicted FROM votes
  QUALIFY row_number() OVER (PARTITION BY film_key ORDER BY votes DESC, label) = 1"""),
)


def _success(spark, sf_dir, target, rare):
    """Films with the leading people and genres, rare ones removed, and a numeric target."""
    chain = film_chain(spark, sf_dir, leading=4)
    if target == "profit":
        year = iso_year(F.col("publication_date"))
        chain = complete(chain, ["ncost", "nbox", "publication_date"]).withColumn(
            "profit", profit(F.col("nbox"), F.col("ncost")) * money_value(year)
        )
    elif target != "weighted_points":
        chain = complete(well_rated(chain), ["audience_average", "critic_average"])
    films = materialize(
        chain.select(
            "film_key", first_n(F.col("director"), 2).alias("director"),
            first_n(F.col("cast_member"), 4).alias("cast_member"),
            first_n(F.col("genre"), 3).alias("genre"), target,
            as_list(F.col("production_company")).alias("company"),
        ),
        "success",
    )
    return remove_rare(films, rare, 1)


def _success_model(
    spark, sf_dir, target, estimator, buckets, columns=SUCCESS_LISTS,
    rare=("cast_member", "director"),
):
    films = materialize(_success(spark, sf_dir, target, rare), "success-kept")
    films = m.bucket_label(films, target, buckets).withColumn(
        "train", m.in_train(F.col("film_key"))
    )
    vectors = m.multi_hot_vectors(films, columns).transform(films)
    vectors = materialize(vectors.select("film_key", target, "label_class", "train", "features"), "vectors")
    train, test = vectors.filter("train"), vectors.filter(~F.col("train"))
    out = m.fit_predict_ones(train, test, estimator, "label_class")
    return out.select("film_key", F.col(target).alias("truth"), "predicted")


def mlp_professional(spark, sf_dir):
    return _success_model(spark, sf_dir, "weighted_points", m.perceptron((25, 15, 5)), 8)


def mlp_professional_accuracy(spark, sf_dir):
    """Awards points scored within 5."""
    return tolerance_accuracy(mlp_professional(spark, sf_dir), "truth", "predicted", 5)


def mlp_social(spark, sf_dir):
    """Audience score from all four blocks, 20 units, scored within 0.15."""
    out = _success_model(spark, sf_dir, "audience_average", m.perceptron((20,)), 8)
    return tolerance_accuracy(out, "truth", "predicted", 0.15)


def mlp_social_critics(spark, sf_dir):
    """Critic score from all four blocks, 5 units, scored within 0.2."""
    out = _success_model(spark, sf_dir, "critic_average", m.perceptron((5,)), 8)
    return tolerance_accuracy(out, "truth", "predicted", 0.2)


def mlp_social_people(spark, sf_dir):
    """Audience score without the company block, 10 units, scored within 0.2."""
    out = _success_model(
        spark, sf_dir, "audience_average", m.perceptron((10,)), 8, SUCCESS_LISTS[:3]
    )
    return tolerance_accuracy(out, "truth", "predicted", 0.2)


def mlp_early(spark, sf_dir):
    """Awards points with two hidden layers of 25 and 4 units."""
    return _success_model(spark, sf_dir, "weighted_points", m.perceptron((25, 4)), 8)


def mlp_commercial(spark, sf_dir):
    """Profit in money of the base year, scored within 888,888."""
    out = _success_model(spark, sf_dir, "profit", m.perceptron((20,)), 8)
    return tolerance_accuracy(out, "truth", "predicted", 888_888)


def mlp_general(spark, sf_dir):
    """Awards points from people and genres of the leading list items, without the company."""
    out = _success_model(
        spark, sf_dir, "weighted_points", m.perceptron((25, 15, 5)), 8, SUCCESS_LISTS[:3],
        ["cast_member", "genre", "director"],
    )
    return tolerance_accuracy(out, "truth", "predicted", 4)


def forest_social_people(spark, sf_dir):
    """The audience forest without the company block, as an ablation."""
    out = _success_model(spark, sf_dir, "audience_average", m.forest(200, 10, 10), 8, SUCCESS_LISTS[:3])
    return tolerance_accuracy(out, "truth", "predicted", 0.25)


def forest_social(spark, sf_dir):
    return _success_model(spark, sf_dir, "audience_average", m.forest(200, 10, 10), 8)


def forest_commercial(spark, sf_dir):
    return _success_model(spark, sf_dir, "profit", m.forest(100, 5, 5), 8)


def tree_commercial(spark, sf_dir):
    return _success_model(spark, sf_dir, "profit", m.tree(20), 8)


def tree_social(spark, sf_dir):
    return _success_model(spark, sf_dir, "critic_average", m.tree(30), 8)


def _multilabel(spark, sf_dir, counts=False):
    """(film, labels, first, chances) of the test films, and the numbered genres."""
    kept, genres = kept_films(spark, sf_dir, clean_text(F.col("plot")).alias("plot"))
    words = without_words(clean_tokens(F.col("plot")), STOP_WORDS).alias("tokens")
    in_train = m.in_train(F.col("film"), 0.8).alias("train")
    films = materialize(kept.select("film", "genres", words, in_train, F.lit(1).alias("mult")), "tokens")
    names = genres.select(F.col("genre").alias("label"), "idx")
    if counts:
        terms = ml.number_terms(fit_vocabulary(films.filter("train"), "tokens"), ["term"])
        cells = term_counts(films, "film", "tokens").withColumnRenamed("tf", "value")
    else:
        terms = fit_vocabulary(films.filter("train"), "tokens", max_df=0.8, max_features=10_000)
        terms = ml.number_terms(terms, [F.col("total").desc(), "term"])
        cells = weighted_terms(films, terms, "film", "tokens").withColumnRenamed("weight", "value")
    cells = cells.select("film", "term", "value")
    rows = ml.pack_rows(cells, films.select("film", "train", "genres"), terms, names, "film", "genres")
    sizes = terms.count(), names.count()
    train, test = rows.filter("train"), rows.filter(~F.col("train"))
    return ml.predicted_chances(train, test, ("film", "labels"), *sizes), names


def multilabel_lr(spark, sf_dir):
    chances, names = _multilabel(spark, sf_dir)
    out = ml.chance_rows(chances, names, "film")
    return out.select("film", "genre", "y", F.round("probability", 6).alias("probability"), "p", "p_low")


def _f1_both(spark, sf_dir, counts=False):
    """F1 of both thresholds from the sets of labels; no row for each film and genre is made."""
    sets = ml.label_sets(_multilabel(spark, sf_dir, counts)[0])
    default = micro_f1_sets(sets, "truth", "p").withColumn("threshold", F.lit(0.5))
    return default.unionByName(micro_f1_sets(sets, "truth", "p_low").withColumn("threshold", F.lit(0.3)))


def multilabel_f1(spark, sf_dir):
    return _f1_both(spark, sf_dir)


def multilabel_f1_counts(spark, sf_dir):
    return _f1_both(spark, sf_dir, counts=True)


def selected_bayes(spark, sf_dir):
    """Multinomial naive Bayes with a class prior on the best fifth of the terms, a sample per film and genre.

    A text is counted once, whatever the number of its genres. Films are told apart by row.
    """
    kept, _ = kept_films(spark, sf_dir, clean_text(F.col("plot")).alias("plot"))
    words = without_words(clean_tokens(F.col("plot")), STOP_WORDS).alias("tokens")
    films = kept.select("film", "genres", words, F.size("genres").alias("mult"), m.in_train(F.col("film"), 0.8).alias("train"))
    films = materialize(films.withColumn("row", F.monotonically_increasing_id()), "tokens")
    train, test = films.filter("train"), films.filter(~F.col("train"))
    samples = train.select(F.explode("genres").alias("class"))
    codes = m.class_values(samples, "class")
    terms = fit_vocabulary(train, "tokens", max_df=0.4, totals=True)
    sums = list_sums(weighted_terms(train, terms, "row", "tokens"), train, "row", "genres")
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("class")).cast("int") - 1
    sums = materialize(sums.withColumn("class", place), "class-sums")
    samples = samples.withColumn("class", place)
    sizes = dict(samples.groupBy("class").count().collect())
    n, k = sum(sizes.values()), len(codes)
    chosen = terms
    if k > 1:
        scores = anova_f(sums, samples).join(terms.select("term", "total"), "term")
        chosen = materialize(select_share(scores, 0.2, f_ceiling(k - 1, max(n - k, 1))), "chosen")
    model = fit_multinomial(sums, chosen, range(k))
    prior = [math.log((sizes[i] + 1) / (n + k)) for i in range(k)]
    weights = weighted_terms(test, terms, "row", "tokens")
    found = predict_multinomial(test, weights, model, range(k), "row", prior=prior)
    predicted = F.get(F.array(*[F.lit(c) for c in codes]), F.col("prediction")).alias("predicted")
    return test.join(found, "row").select("film", F.explode("genres").alias("genre"), predicted)


def polynomial_r2(spark, sf_dir):
    """Hold-out fit of critic on audience percent by a polynomial of degree 2."""
    rated = _rated(spark, sf_dir)
    model = m.polynomial_fit(rated.filter("train"), "audience_percent", "critic_percent", 2)
    out = model.transform(rated.filter(~F.col("train")))
    return out.select("film_key", "critic_percent", F.round("fitted", 4).alias("fitted"))


POLYNOMIAL_SQL = with_ctes(
    FILMS_CTE,
    """
pts AS (
  SELECT film_key, audience_percent AS x, audience_percent * audience_percent AS x2,
    critic_percent AS y, substr(md5(CAST(film_key AS VARCHAR)), 1, 8) < 'c0000000' AS train
  FROM ratings WHERE audience_ratings >= 40 AND critic_average IS NOT NULL AND critic_percent IS NOT NULL
),
s AS (
  SELECT var_pop(x) AS a, var_pop(x2) AS b, covar_pop(x, x2) AS c, covar_pop(x, y) AS p,
    covar_pop(x2, y) AS q, avg(x) AS mx, avg(x2) AS mx2, avg(y) AS my FROM pts WHERE train
),
beta AS (
  SELECT *, (b * p - c * q) / (a * b - c * c) AS b1, (a * q - c * p) / (a * b - c * c) AS b2 FROM s
)""",
    select="""
SELECT film_key, y AS critic_percent, round(my + b1 * (x - mx) + b2 * (x2 - mx2), 4) AS fitted
FROM pts, beta WHERE NOT train""",
)

QUERIES = {
    "standardised": (standardised, STANDARD_SQL),
    "knn_neighbours": (knn_neighbours, KNN_SQL),
    "knn_vote": (knn_vote, KNN_VOTE_SQL),
    "gaussian_bayes": (gaussian_bayes, GAUSSIAN_SQL),
    "gaussian_accuracy": (gaussian_accuracy, GAUSSIAN_ACCURACY_SQL),
    "knn_accuracy": (knn_accuracy, KNN_ACCURACY_SQL),
    "linear_svm": (linear_svm, None),
    "svm_accuracy": (svm_accuracy, None),
    "mlp_professional": (mlp_professional, None),
    "mlp_professional_accuracy": (mlp_professional_accuracy, None),
    "mlp_social": (mlp_social, None),
    "mlp_social_critics": (mlp_social_critics, None),
    "mlp_social_people": (mlp_social_people, None),
    "mlp_early": (mlp_early, None),
    "mlp_commercial": (mlp_commercial, None),
    "mlp_general": (mlp_general, None),
    "forest_social": (forest_social, None),
    "forest_social_people": (forest_social_people, None),
    "forest_commercial": (forest_commercial, None),
    "tree_commercial": (tree_commercial, None),
    "tree_social": (tree_social, None),
    "multilabel_lr": (multilabel_lr, None),
    "multilabel_f1": (multilabel_f1, None),
    "multilabel_f1_counts": (multilabel_f1_counts, None),
    "selected_bayes": (selected_bayes, None),
    "polynomial_fit": (polynomial_r2, POLYNOMIAL_SQL),
}
