"""Cleaning, word counts, term weights, term selection and naive Bayes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.bayes import fit_multinomial, predict_multinomial
from ..operators.genres import predict_rows
from ..operators.metrics import exact_accuracy, sibling_accuracy
from ..operators.models import class_values, in_train
from ..operators.tfidf import (
    anova_f,
    class_sums,
    fit_vocabulary,
    select_percentile,
    term_counts,
    weighted_terms,
)
from ..operators.wordfreq import drop_stop_words, top_words, without_stop_words, word_counts
from ..session import materialize
from . import views as v
from .list_queries import KEPT_CTE, kept_films
from .views import PLOTS_CTE, STOP_CTE, STOP_WORDS, with_ctes

TRAIN_SQL = "substr(md5(CAST(film AS VARCHAR)), 1, 8) < 'c0000000'"
_CLEAN = "lower(trim(regexp_replace(replace(plot, '''', ''), '[^a-zA-Z]+', ' ', 'g')))"
CLEAN_CTE = f"""{PLOTS_CTE},{STOP_CTE},
cleaned AS (SELECT film, {_CLEAN} AS plot FROM plots),
lists AS (SELECT film, list_filter(string_split(plot, ' '), lambda t: t <> '') AS s FROM cleaned),
words AS (SELECT film, UNNEST(s) AS word, generate_subscripts(s, 1) AS pos FROM lists)"""


def _cleaned(spark, sf_dir):
    return v.plot_texts(spark, sf_dir).select("film", clean_text(F.col("plot")).alias("plot"))


def cleaned_text(spark, sf_dir):
    return _cleaned(spark, sf_dir)


CLEAN_SQL = with_ctes(CLEAN_CTE, select="SELECT film, plot FROM cleaned")


def word_freq_top32(spark, sf_dir):
    """Most frequent words before stop words are removed."""
    return top_words(word_counts(_cleaned(spark, sf_dir), "plot"), 32)


def word_freq_content(spark, sf_dir):
    """Most frequent words after an anti join with the stop-word table."""
    counts = word_counts(_cleaned(spark, sf_dir), "plot")
    return top_words(drop_stop_words(counts, v.stop_words(spark)), 32)


WORD_FREQ_SQL = with_ctes(
    CLEAN_CTE,
    select="SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 32",
)
WORD_CONTENT_SQL = with_ctes(
    CLEAN_CTE,
    select="""
SELECT word, count(*) AS n FROM words WHERE word NOT IN (SELECT word FROM stop_words)
GROUP BY word ORDER BY n DESC, word LIMIT 32""",
)


def stopword_removed(spark, sf_dir):
    return without_stop_words(_cleaned(spark, sf_dir), "plot", STOP_WORDS)


STOPWORD_SQL = with_ctes(
    CLEAN_CTE,
    """
kept AS (
  SELECT film, string_agg(word, ' ' ORDER BY pos) AS plot FROM words
  WHERE word NOT IN (SELECT word FROM stop_words) GROUP BY film
)""",
    select="SELECT film, coalesce(k.plot, '') AS plot FROM cleaned LEFT JOIN kept k USING (film)",
)


def word_vectors(spark, sf_dir):
    """Word counts per film in long form."""
    return term_counts(materialize(_cleaned(spark, sf_dir), "cleaned"), "film", "plot", STOP_WORDS)


TERMS_CTE = """
terms AS (
  SELECT film, word AS term, count(*) AS tf FROM words
  WHERE length(word) >= 2 AND word NOT IN (SELECT word FROM stop_words) GROUP BY film, word
)"""
WORD_VECTORS_SQL = with_ctes(CLEAN_CTE, TERMS_CTE, select="SELECT film, term, tf FROM terms")


def labelled_films(spark, sf_dir):
    """Kept films with cleaned plot, sample weight and side of the split; and their genres."""
    kept, vocabulary = kept_films(spark, sf_dir, clean_text(F.col("plot")).alias("plot"))
    kept = kept.withColumn("train", in_train(F.col("film")))
    kept = kept.withColumn("mult", F.size("genres").cast("long"))
    # The fit and both transforms read the plots, so they are cleaned once.
    return materialize(kept, "cleaned"), vocabulary


def _terms(spark, sf_dir):
    kept, _ = labelled_films(spark, sf_dir)
    return kept, fit_vocabulary(kept.filter("train"), "plot", STOP_WORDS, 0.8, 10_000)


def term_vocabulary(spark, sf_dir):
    return _terms(spark, sf_dir)[1].select("term", "df", "total", F.round("idf", 6).alias("idf"))


def tfidf_long(spark, sf_dir):
    kept, terms = _terms(spark, sf_dir)
    weights = weighted_terms(kept, terms, "film", "plot", STOP_WORDS)
    return weights.select("film", "term", "tf", F.round("weight", 6).alias("weight"))


def _sql_weights(max_df: str, limit: str = "") -> str:
    return f"""{KEPT_CTE},{STOP_CTE},
cleaned AS (SELECT film, {_CLEAN} AS plot FROM plots),
lists AS (SELECT film, list_filter(string_split(plot, ' '), lambda t: length(t) >= 2) AS s FROM cleaned),
words AS (SELECT film, UNNEST(s) AS word FROM lists),{TERMS_CTE},
samples AS (SELECT row_idx, film, genres_number AS class, {TRAIN_SQL} AS train FROM predict),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM samples WHERE train),
vocab AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total,
    ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf
  FROM terms JOIN samples USING (film), size WHERE train GROUP BY term
  HAVING count(*) <= {max_df} * any_value(n) {limit}
),
raw AS (SELECT film, term, tf, tf * idf AS w FROM terms JOIN vocab USING (term)),
weights AS (
  SELECT film, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY film)) AS weight FROM raw
)"""


VOCABULARY_SQL = with_ctes(
    _sql_weights("0.8", "ORDER BY total DESC, term LIMIT 10000"),
    select="SELECT term, df, total, round(idf, 6) AS idf FROM vocab",
)
TFIDF_SQL = with_ctes(
    _sql_weights("0.8", "ORDER BY total DESC, term LIMIT 10000"),
    select="SELECT film, term, tf, round(weight, 6) AS weight FROM weights WHERE film IN (SELECT film FROM samples)",
)


def _selection(spark, sf_dir):
    """Samples per (film, genre), class sums of the training weights, and the chosen terms."""
    kept, vocabulary = labelled_films(spark, sf_dir)
    train = kept.filter("train")
    terms = fit_vocabulary(train, "plot", STOP_WORDS, 0.4)
    rows = predict_rows(kept.select("film", "genres", "train"), vocabulary, keep=("train",))
    samples = rows.filter("train").select("film", F.col("genres_number").alias("class"))
    weights = weighted_terms(train, terms, "film", "plot", STOP_WORDS)
    sums = materialize(class_sums(weights, samples, "film"), "class-sums")
    return kept, vocabulary, rows, terms, sums, select_percentile(anova_f(sums, samples), 20)


def anova_select(spark, sf_dir):
    chosen = _selection(spark, sf_dir)[5]
    return chosen.select("term", F.round("f", 4).alias("f"))


SELECT_CTE = f"""{_sql_weights("0.4")},
train_s AS (SELECT film, class FROM samples WHERE train),
sizes AS (SELECT class, count(*) AS size FROM train_s GROUP BY class),
shape AS (SELECT CAST(sum(size) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS k FROM sizes),
class_sums AS (
  SELECT term, class, sum(weight) AS s, sum(weight * weight) AS q
  FROM weights JOIN train_s USING (film) GROUP BY term, class
),
moments AS (
  SELECT term, sum(s) AS s, sum(q) AS q, sum(s * s / size) AS b
  FROM class_sums JOIN sizes USING (class) GROUP BY term
),
scores AS (
  SELECT term, CASE WHEN q - b > 1e-12 AND k > 1 THEN
    round(((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)), 8) END AS f
  FROM moments, shape
),
chosen AS (
  SELECT term, f FROM (
    SELECT *, row_number() OVER (ORDER BY coalesce(f, CAST('-inf' AS DOUBLE)) DESC, term) AS r, count(*) OVER () AS v
    FROM scores) WHERE r <= ceil((v - 1) * 20 / 100.0)
)"""
ANOVA_SQL = with_ctes(SELECT_CTE, select="SELECT term, round(f, 4) AS f FROM chosen")


def bayes_predictions(spark, sf_dir):
    """(all samples, test films with the predicted genre number)."""
    kept, vocabulary, rows, terms, sums, chosen = _selection(spark, sf_dir)
    classes = class_values(vocabulary, "idx")
    model = fit_multinomial(sums, materialize(chosen, "chosen"), classes)
    test = kept.filter(~F.col("train"))
    weights = weighted_terms(test, terms, "film", "plot", STOP_WORDS)
    return rows, predict_multinomial(test.select("film"), weights, model, classes, "film")


def nb_multinomial(spark, sf_dir):
    return bayes_predictions(spark, sf_dir)[1]


BAYES_CTE = f"""{SELECT_CTE},
kept_sums AS (SELECT c.* FROM class_sums c JOIN chosen USING (term)),
class_total AS (
  SELECT idx AS class, coalesce((SELECT sum(s) FROM kept_sums t WHERE t.class = g.idx), 0)
    + (SELECT count(*) FROM chosen) AS total FROM kept_genres g
),
test AS (SELECT DISTINCT film FROM samples WHERE NOT train),
x AS (SELECT film, term, weight FROM weights JOIN test USING (film) JOIN chosen USING (term)),
scores_by_class AS (
  SELECT t.film, c.class,
    coalesce(sum(x.weight * ln((coalesce(s.s, 0) + 1) / c.total)), 0) AS score
  FROM test t CROSS JOIN class_total c LEFT JOIN x ON x.film = t.film
  LEFT JOIN kept_sums s ON s.term = x.term AND s.class = c.class
  GROUP BY t.film, c.class
),
nb AS (
  SELECT film, CAST(class AS INTEGER) AS prediction FROM scores_by_class
  QUALIFY row_number() OVER (PARTITION BY film ORDER BY round(score, 9) DESC, class) = 1
)"""
NB_SQL = with_ctes(BAYES_CTE, select="SELECT film, prediction FROM nb")


def nb_accuracy(spark, sf_dir):
    """Plain accuracy over the test samples, and accuracy against any genre of the film."""
    rows, predicted = bayes_predictions(spark, sf_dir)
    tested = materialize(rows.filter(~F.col("train")).join(predicted, "film"), "tested")
    plain = exact_accuracy(tested, "genres_number", "prediction").select(
        F.lit("exact").alias("score"), "n", F.round("accuracy", 6).alias("accuracy")
    )
    near = sibling_accuracy(tested, rows, "film").select(
        F.lit("sibling").alias("score"), "n", F.round("accuracy", 6).alias("accuracy")
    )
    return plain.unionByName(near)


NB_ACCURACY_SQL = with_ctes(
    BAYES_CTE,
    "\ntested AS (SELECT film, class, prediction FROM samples JOIN nb USING (film) WHERE NOT train)",
    select="""
SELECT 'exact' AS score, count(*) AS n, round(avg(CASE WHEN class = prediction THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM tested
UNION ALL
SELECT 'sibling', count(*), round(avg(CASE WHEN EXISTS (SELECT 1 FROM samples s WHERE s.film = t.film
  AND s.class = t.prediction) THEN 1.0::DOUBLE ELSE 0 END), 6) FROM tested t""",
)


QUERIES = {
    "clean_text": (cleaned_text, CLEAN_SQL),
    "word_freq_top32": (word_freq_top32, WORD_FREQ_SQL),
    "word_freq_content": (word_freq_content, WORD_CONTENT_SQL),
    "stopword_removed": (stopword_removed, STOPWORD_SQL),
    "word_vectors": (word_vectors, WORD_VECTORS_SQL),
    "term_vocabulary": (term_vocabulary, VOCABULARY_SQL),
    "tfidf_long": (tfidf_long, TFIDF_SQL),
    "anova_select": (anova_select, ANOVA_SQL),
    "nb_multinomial": (nb_multinomial, NB_SQL),
    "nb_accuracy": (nb_accuracy, NB_ACCURACY_SQL),
}
