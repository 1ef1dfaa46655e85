"""Genre lists, rare elements and multi-hot features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lists import as_list, first_n
from ..functions.text import fingerprint
from ..operators.genres import (
    first_seen,
    frequent_genres,
    genre_counts,
    genre_list,
    genre_rows,
    genre_shares,
    genre_vocabulary,
    keep_genres,
    predict_rows,
)
from ..operators.metrics import micro_f1_sets, neighbour_accuracy, sibling_accuracy
from ..operators.models import in_train, label_matrix
from ..operators.rare import drop_empty_lists, remove_rare, remove_rare_by_rows
from ..operators.sentiment import document_sentiment, genre_sentiment
from ..operators.vocabulary import concat_features, multi_hot
from ..session import materialize
from . import views as v
from .table_queries import CHAIN_CTE, film_chain
from .views import CREDITS_CTE, LEXICON_CTE, MIN_SUPPORT, PLOTS_CTE, with_ctes


def _text(column):
    return F.array_join(column, "|")


def _sentiment(spark, sf_dir):
    return document_sentiment(v.plot_texts(spark, sf_dir), v.lexicon(spark), "film", "plot", ("genres",))


def sentiment_by_genre(spark, sf_dir):
    return genre_sentiment(_sentiment(spark, sf_dir))


def sentiment_by_film(spark, sf_dir):
    return _sentiment(spark, sf_dir).select("film", "score")


SENTIMENT_CTE = f"""{PLOTS_CTE},{LEXICON_CTE},
tokens AS (
  SELECT film, UNNEST(regexp_extract_all(lower(plot), '([\\p{{L}}\\p{{N}}_]+)', 1)) AS word FROM plots
),
hits AS (SELECT film, sum(polarity) AS s FROM tokens JOIN lexicon USING (word) GROUP BY film),
scored AS (
  SELECT film, CAST(coalesce(s, 0) AS BIGINT) AS score, genres FROM plots LEFT JOIN hits USING (film)
)"""
SENTIMENT_SQL = with_ctes(
    SENTIMENT_CTE,
    "\ng AS (SELECT UNNEST(list_distinct(genres)) AS genre, score FROM scored)",
    select="""
SELECT genre, CAST(sum(score) AS BIGINT) AS total_score,
  CAST(count(*) FILTER (WHERE score <> 0) AS BIGINT) AS n_records,
  CASE WHEN count(*) FILTER (WHERE score <> 0) > 0 THEN
    CAST(round_even(CAST(sum(score) AS DOUBLE) / count(*) FILTER (WHERE score <> 0), 2) AS DOUBLE)
  END AS mean_score
FROM g GROUP BY genre""",
)
FILM_SENTIMENT_SQL = with_ctes(SENTIMENT_CTE, select="SELECT film, score FROM scored")


def _genre_films(spark, sf_dir):
    return v.plots(spark, sf_dir).select("film", "genres")


def genre_count(spark, sf_dir):
    return genre_counts(_genre_films(spark, sf_dir))


def genre_share(spark, sf_dir):
    kept = frequent_genres(_genre_films(spark, sf_dir), MIN_SUPPORT)
    return genre_shares(kept).select("genre", "n", F.round("share", 6).alias("share"))


def genre_filter(spark, sf_dir):
    films = _genre_films(spark, sf_dir)
    kept = keep_genres(films, genre_vocabulary(films, MIN_SUPPORT))
    return kept.select("film", _text("genres").alias("genres"))


def genre_text_totals(spark, sf_dir):
    """Plots grouped by genre in long form: number of plots and of letters per genre."""
    plots = v.plots(spark, sf_dir).select("film", "genres", F.length("plot").alias("size"))
    rows = genre_rows(plots, "film", "genres", ("size",))
    return rows.groupBy("genre").agg(
        F.count(F.lit(1)).alias("n_plots"), F.sum("size").cast("long").alias("n_letters")
    )


def kept_films(spark, sf_dir, *extra):
    """Films with their frequent genres, and those genres numbered in first-seen order."""
    vocabulary = genre_vocabulary(_genre_films(spark, sf_dir), MIN_SUPPORT)
    films = v.plot_texts(spark, sf_dir) if extra else _genre_films(spark, sf_dir)
    return keep_genres(films.select("film", "genres", *extra), vocabulary), vocabulary


def genre_index(spark, sf_dir):
    vocabulary = genre_vocabulary(_genre_films(spark, sf_dir), MIN_SUPPORT)
    return vocabulary.select("genre", F.col("idx").cast("int").alias("idx"))


def genre_first_seen(spark, sf_dir):
    """Every distinct genre, numbered by first appearance."""
    index = first_seen(genre_rows(_genre_films(spark, sf_dir)), "genre", "film")
    return index.select("genre", F.col("idx").cast("int").alias("idx"))


def genre_explode(spark, sf_dir):
    kept, vocabulary = kept_films(spark, sf_dir)
    return predict_rows(kept, vocabulary)


KEPT_CTE = f"""{PLOTS_CTE},
entries AS (SELECT film, plot, UNNEST(genres) AS genre, generate_subscripts(genres, 1) AS pos FROM plots),
counts AS (SELECT genre, count(*) AS n, min(film * 1000 + pos) AS first FROM entries GROUP BY genre),
kept_genres AS (
  SELECT genre, n, CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER) AS idx
  FROM counts WHERE n >= {MIN_SUPPORT}
),
predict AS (
  SELECT row_number() OVER (ORDER BY film, pos) - 1 AS row_idx, film, idx AS genres_number, plot
  FROM entries JOIN kept_genres USING (genre)
)"""
GENRE_COUNT_SQL = with_ctes(KEPT_CTE, select="SELECT genre, n FROM counts")
GENRE_SHARE_SQL = with_ctes(
    KEPT_CTE,
    select="SELECT genre, n, round(n / sum(n) OVER (), 6) AS share FROM kept_genres",
)
GENRE_FILTER_SQL = with_ctes(
    KEPT_CTE,
    select="""
SELECT film, string_agg(genre, '|' ORDER BY pos) AS genres FROM entries JOIN kept_genres USING (genre)
GROUP BY film""",
)
GENRE_TEXT_SQL = with_ctes(
    KEPT_CTE,
    select="SELECT genre, count(*) AS n_plots, CAST(sum(length(plot)) AS BIGINT) AS n_letters FROM entries GROUP BY genre",
)
GENRE_FIRST_SQL = with_ctes(
    KEPT_CTE,
    select="SELECT genre, CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER) AS idx FROM counts",
)
GENRE_INDEX_SQL = with_ctes(KEPT_CTE, select="SELECT genre, idx FROM kept_genres")
GENRE_EXPLODE_SQL = with_ctes(KEPT_CTE, select="SELECT row_idx, film, genres_number FROM predict")


def _guess(n_genres):
    """A fixed rule that stands in for a model: it depends on the film only."""
    return F.pmod(F.col("film"), F.lit(n_genres)).cast("int")


def sibling_share(spark, sf_dir):
    kept, vocabulary = kept_films(spark, sf_dir)
    rows = predict_rows(kept, vocabulary)
    tested = rows.filter(~in_train(F.col("film"))).withColumn("prediction", _guess(3))
    share = sibling_accuracy(tested, rows, "film")
    return share.select("n", F.round("accuracy", 6).alias("accuracy"))


SIBLING_SQL = with_ctes(
    KEPT_CTE,
    "\ntested AS (SELECT film, CAST(film % 3 AS INTEGER) AS p FROM predict WHERE substr(md5(CAST(film AS VARCHAR)), 1, 8) >= 'c0000000')",
    select="""
SELECT count(*) AS n, round(avg(CASE WHEN EXISTS (
  SELECT 1 FROM predict q WHERE q.film = t.film AND q.genres_number = t.p) THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
FROM tested t""",
)


def neighbour_share(spark, sf_dir):
    kept, vocabulary = kept_films(spark, sf_dir, fingerprint(F.col("plot")).alias("plot"))
    rows = predict_rows(kept, vocabulary, keep=("plot",))
    guess = F.when(~in_train(F.col("film")), _guess(3))
    share = neighbour_accuracy(rows.withColumn("prediction", guess), "row_idx", "plot")
    return share.select("n", F.round("accuracy", 6).alias("accuracy"))


NEIGHBOUR_SQL = with_ctes(
    KEPT_CTE,
    """
near AS (
  SELECT film, genres_number AS g, plot, CAST(film % 3 AS INTEGER) AS p,
"""
    + ",\n".join(
        f"    {f}(genres_number, {o}) OVER w AS g_{f}{o}, {f}(plot, {o}) OVER w AS t_{f}{o}"
        for f in ("lag", "lead")
        for o in (1, 2)
    )
    + """
  FROM predict WINDOW w AS (ORDER BY row_idx)
)""",
    select="SELECT count(*) AS n, round(avg(CASE WHEN p = g"
    + "".join(
        f" OR (coalesce(t_{f}{o} = plot, false) AND g_{f}{o} = p)" for f in ("lag", "lead") for o in (1, 2)
    )
    + " THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM near"
    " WHERE substr(md5(CAST(film AS VARCHAR)), 1, 8) >= 'c0000000'",
)


def genre_matrix(spark, sf_dir):
    kept, vocabulary = kept_films(spark, sf_dir)
    return label_matrix(kept, "film", "genres", genre_list(vocabulary))


MATRIX_SQL = with_ctes(
    KEPT_CTE,
    "\nfilms AS (SELECT DISTINCT film FROM predict)",
    select="""
SELECT f.film, k.genre, CAST(EXISTS (SELECT 1 FROM predict p WHERE p.film = f.film
  AND p.genres_number = k.idx) AS INTEGER) AS y FROM films f CROSS JOIN kept_genres k""",
)


def micro_f1_rule(spark, sf_dir):
    """Micro F1 of a fixed rule: every film is given the first genre, and odd films the second.

    True and predicted genres stay sets of each film; no row for each film and genre is made.
    """
    kept, vocabulary = kept_films(spark, sf_dir)
    first, second = (vocabulary.filter(F.col("idx") == i).agg(F.max("genre")).scalar() for i in (0, 1))
    given = F.when(F.col("film") % 2 == 1, F.array(first, second)).otherwise(F.array(first))
    sets = kept.select(F.col("genres").alias("truth"), F.array_compact(given).alias("p"))
    return micro_f1_sets(sets).select("tp", "fp", "fn", F.round("f1", 6).alias("f1"))


MICRO_F1_SQL = with_ctes(
    KEPT_CTE,
    "\nfilms AS (SELECT DISTINCT film FROM predict)",
    """
m AS (
  SELECT EXISTS (SELECT 1 FROM predict p WHERE p.film = f.film AND p.genres_number = k.idx) AS y,
    k.idx = 0 OR (k.idx = 1 AND f.film % 2 = 1) AS p
  FROM films f CROSS JOIN kept_genres k
)""",
    """
c AS (
  SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
    count(*) FILTER (WHERE y AND NOT p) AS fn FROM m
)""",
    select="SELECT tp, fp, fn, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1 FROM c",
)


def _chain_lists(spark, sf_dir, leading=None):
    return materialize(
        film_chain(spark, sf_dir, leading).select(
            "film_key", "cast_member", "genre", "director", "production_company", "weighted_points",
            "audience_percent",
        ),
        "chain",
    )


def _lists(df, *columns):
    return df.select("film_key", *[_text(c).alias(c) for c in columns])


def rare_removal_cast(spark, sf_dir):
    films = materialize(v.credits(spark, sf_dir).select("film_key", "cast_member"), "credits")
    return _lists(remove_rare(films, ["cast_member"], 31), "cast_member")


def rare_removal_chain(spark, sf_dir):
    kept = remove_rare(_chain_lists(spark, sf_dir), ["cast_member", "genre", "director"])
    return _lists(kept, "cast_member", "genre", "director")


def rare_removal_rows(spark, sf_dir):
    kept = remove_rare_by_rows(_chain_lists(spark, sf_dir), "cast_member", 1)
    return _lists(kept, "cast_member")


def rare_rows_dropped(spark, sf_dir):
    kept = remove_rare_by_rows(_chain_lists(spark, sf_dir), "cast_member", 2)
    return _lists(drop_empty_lists(kept, "cast_member"), "cast_member")


def _sql_rare(step: str, source: str, column: str, least: int, others: str) -> str:
    return f"""
{step}_e AS (SELECT film_key, UNNEST({column}) AS elem, generate_subscripts({column}, 1) AS pos FROM {source}),
{step}_k AS (SELECT elem FROM {step}_e GROUP BY elem HAVING count(*) > {least}),
{step} AS (
  SELECT s.film_key, {others} t.items AS {column} FROM {source} s JOIN (
    SELECT film_key, list(elem ORDER BY pos) AS items FROM {step}_e JOIN {step}_k USING (elem)
    GROUP BY film_key) t ON s.film_key = t.film_key
)"""


RARE_CAST_SQL = with_ctes(
    CREDITS_CTE,
    _sql_rare("r1", "credits", "cast_member", 31, ""),
    select="SELECT film_key, array_to_string(cast_member, '|') AS cast_member FROM r1",
)
RARE_CHAIN_CTE = ",".join(
    [
        CHAIN_CTE,
        _sql_rare("r1", "chain", "cast_member", 1, "s.genre, s.director,"),
        _sql_rare("r2", "r1", "genre", 1, "s.cast_member, s.director,"),
        _sql_rare("r3", "r2", "director", 1, "s.cast_member, s.genre,"),
    ]
)
RARE_CHAIN_SQL = with_ctes(
    RARE_CHAIN_CTE,
    select="""
SELECT film_key, array_to_string(cast_member, '|') AS cast_member,
  array_to_string(genre, '|') AS genre, array_to_string(director, '|') AS director FROM r3""",
)


def _sql_rare_rows(least: int) -> str:
    return f"""
e AS (SELECT film_key, UNNEST(cast_member) AS elem, generate_subscripts(cast_member, 1) AS pos FROM chain),
k AS (SELECT elem FROM e GROUP BY elem HAVING count(DISTINCT film_key) > {least}),
kept AS (SELECT film_key, list(elem ORDER BY pos) AS items FROM e JOIN k USING (elem) GROUP BY film_key)"""


RARE_ROWS_SQL = with_ctes(
    CHAIN_CTE,
    _sql_rare_rows(1),
    select="""
SELECT c.film_key, coalesce(array_to_string(items, '|'), '') AS cast_member
FROM chain c LEFT JOIN kept k ON c.film_key = k.film_key""",
)
RARE_ROWS_DROPPED_SQL = with_ctes(
    CHAIN_CTE,
    _sql_rare_rows(2),
    select="SELECT film_key, array_to_string(items, '|') AS cast_member FROM kept",
)


def multi_hot_long(spark, sf_dir):
    return multi_hot(_chain_lists(spark, sf_dir), "film_key", "cast_member")


def _sql_block(name: str, column: str) -> str:
    return f"""
{name}_e AS (SELECT film_key, UNNEST({column}) AS term, generate_subscripts({column}, 1) AS pos FROM blocks),
{name}_v AS (
  SELECT term, row_number() OVER (ORDER BY f) - 1 AS idx
  FROM (SELECT term, min(film_key * 1000 + pos) AS f FROM {name}_e GROUP BY term)
),
{name} AS (SELECT DISTINCT film_key, term, idx FROM {name}_e JOIN {name}_v USING (term))"""


MULTI_HOT_SQL = with_ctes(
    CHAIN_CTE,
    "\nblocks AS (SELECT film_key, cast_member FROM chain)",
    _sql_block("b1", "cast_member"),
    select="SELECT film_key, term, idx FROM b1",
)


def feature_concat(spark, sf_dir):
    """Director, cast, genre and company blocks of the leading list items, side by side."""
    films = _chain_lists(spark, sf_dir, leading=3).select(
        "film_key",
        first_n(F.col("director"), 2).alias("director"),
        first_n(F.col("cast_member"), 3).alias("cast_member"),
        first_n(F.col("genre"), 2).alias("genre"),
        as_list(F.col("production_company")).alias("company"),
    )
    return concat_features(films, "film_key", ["director", "cast_member", "genre", "company"])


CONCAT_SQL = with_ctes(
    CHAIN_CTE,
    """
blocks AS (
  SELECT film_key, director[1:2] AS director, cast_member[1:3] AS cast_member,
    genre[1:2] AS genre, [production_company] AS company FROM chain
)""",
    _sql_block("b1", "director"),
    _sql_block("b2", "cast_member"),
    _sql_block("b3", "genre"),
    _sql_block("b4", "company"),
    """
sizes AS (
  SELECT (SELECT count(*) FROM b1_v) AS s1, (SELECT count(*) FROM b2_v) AS s2,
    (SELECT count(*) FROM b3_v) AS s3
)""",
    select="""
SELECT film_key, 'director' AS block, term, idx AS feature FROM b1
UNION ALL SELECT film_key, 'cast_member', term, CAST(idx + s1 AS BIGINT) FROM b2, sizes
UNION ALL SELECT film_key, 'genre', term, CAST(idx + s1 + s2 AS BIGINT) FROM b3, sizes
UNION ALL SELECT film_key, 'company', term, CAST(idx + s1 + s2 + s3 AS BIGINT) FROM b4, sizes""",
)

QUERIES = {
    "genre_sentiment": (sentiment_by_genre, SENTIMENT_SQL),
    "film_sentiment": (sentiment_by_film, FILM_SENTIMENT_SQL),
    "genre_counts": (genre_count, GENRE_COUNT_SQL),
    "genre_share": (genre_share, GENRE_SHARE_SQL),
    "genre_filter": (genre_filter, GENRE_FILTER_SQL),
    "genre_plots": (genre_text_totals, GENRE_TEXT_SQL),
    "genre_first_seen": (genre_first_seen, GENRE_FIRST_SQL),
    "genre_index": (genre_index, GENRE_INDEX_SQL),
    "genre_explode": (genre_explode, GENRE_EXPLODE_SQL),
    "genre_matrix": (genre_matrix, MATRIX_SQL),
    "sibling_accuracy": (sibling_share, SIBLING_SQL),
    "neighbour_accuracy": (neighbour_share, NEIGHBOUR_SQL),
    "micro_f1": (micro_f1_rule, MICRO_F1_SQL),
    "rare_removal_cast": (rare_removal_cast, RARE_CAST_SQL),
    "rare_removal_chain": (rare_removal_chain, RARE_CHAIN_SQL),
    "rare_removal_rows": (rare_removal_rows, RARE_ROWS_SQL),
    "rare_rows_dropped": (rare_rows_dropped, RARE_ROWS_DROPPED_SQL),
    "multi_hot_long": (multi_hot_long, MULTI_HOT_SQL),
    "feature_concat": (feature_concat, CONCAT_SQL),
}
