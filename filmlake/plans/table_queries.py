"""Queries on entities, films, ratings and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.awards import AWARD_PATTERNS, AWARD_WEIGHTS, EARLY_AWARD_WEIGHTS, awards_score
from ..functions.dates import iso_year, partial_date
from ..functions.money import money_value, profit, profit_rate
from ..operators.claims import CLAIM_NAMES, QUANTITY_COLUMNS, claim_rejects
from ..operators.enrich import enrich_films, films_to_fetch
from ..operators.films import genre_map, label_map, select_films
from ..operators.joins import complete, join_chain, join_ratings, well_rated
from ..operators.profile import table_profile, value_range
from ..session import materialize
from . import views as v
from .views import CREDITS_CTE, DUMP_CTE, FILMS_CTE, PLOTS_CTE, with_ctes


def _text(column):
    return F.array_join(column, "|")


def claims_extract(spark, sf_dir):
    return shown_claims(v.entities(spark, sf_dir))


def shown_claims(e):
    """All columns of the slim table, lists as text."""
    pair = F.transform("box_office", lambda q: F.concat_ws(" ", q["amount"], q["unit"]))
    paid = F.transform("cost", lambda q: F.concat_ws(" ", q["amount"], q["unit"]))
    lists = [name for name in CLAIM_NAMES.values() if name not in QUANTITY_COLUMNS]
    return e.select(
        "id", "label", "enwiki_title", *[_text(c).alias(c) for c in lists],
        _text(pair).alias("box_office"), _text(paid).alias("cost"),
    )


def _sql_claim(code: str, name: str) -> str:
    value = f"json_extract(j, '$.claims.{code}[*].mainsnak.datavalue.value')"
    read = (
        "CASE WHEN json_type(x) = 'VARCHAR' THEN json_extract_string(x, '$') ELSE coalesce("
        "json_extract_string(x, '$.id'), json_extract_string(x, '$.text'), "
        "json_extract_string(x, '$.time')) END"
    )
    if name in QUANTITY_COLUMNS:
        read = (
            "json_extract_string(x, '$.amount') || ' ' || "
            "list_last(string_split(json_extract_string(x, '$.unit'), '/'))"
        )
    items = f"list_filter([{read} FOR x IN {value}], lambda y: y IS NOT NULL)"
    return f"CASE WHEN len({items}) > 0 THEN array_to_string({items}, '|') END AS {name}"


CLAIMS_EXTRACT_SQL = with_ctes(
    DUMP_CTE,
    select="SELECT json_extract_string(j, '$.id') AS id, "
    "json_extract_string(j, '$.labels.en.value') AS label, "
    "json_extract_string(j, '$.sitelinks.enwiki.title') AS enwiki_title, "
    + ", ".join(_sql_claim(c, n) for c, n in CLAIM_NAMES.items())
    + " FROM parsed WHERE j IS NOT NULL",
)


def claims_rejects(spark, sf_dir):
    return claim_rejects(v.parsed_dump(spark, sf_dir))


CLAIMS_REJECTS_SQL = with_ctes(
    DUMP_CTE,
    select="""
SELECT CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS claim, line AS detail
FROM parsed WHERE j IS NULL
UNION ALL
SELECT json_extract_string(j, '$.id'), 'P921',
  CAST(json_extract(j, '$.claims.P921[0].mainsnak.datavalue.value') AS VARCHAR)
FROM parsed WHERE json_extract(j, '$.claims.P921[0].mainsnak.datavalue.value') IS NOT NULL""",
)


def films_select(spark, sf_dir):
    f = select_films(v.entities(spark, sf_dir))
    return f.select(
        "wikidata_id", "label", "imdb_id", "rotten_tomatoes_id", "metacritic_id", "enwiki_title",
        *[_text(c).alias(c) for c in ("genre", "main_subject", "filming_location", "director", "cast_member")],
        "series", "production_company", "publication_date", "based_on", "country_of_origin",
        "original_language", "made_profit", "nbox", "ncost",
    )


_RAW_DATE = "CAST(o_orderdate AS DATE)"
_PARTIAL_SQL = (
    f"CASE o_orderkey % 4 WHEN 0 THEN {_RAW_DATE} "
    f"WHEN 1 THEN CAST(date_trunc('month', {_RAW_DATE}) AS DATE) "
    f"WHEN 2 THEN make_date(year({_RAW_DATE}), 1, 1) "
    f"ELSE make_date(year({_RAW_DATE}), 2, 1) END"
)
FILMS_SELECT_SQL = f"""
SELECT 'Q' || o_orderkey AS wikidata_id,
  CASE WHEN o_orderkey % 17 <> 0 THEN 'Film ' || o_orderkey END AS label,
  'tt' || o_orderkey AS imdb_id, 'm/' || o_orderkey AS rotten_tomatoes_id,
  'Film (' || o_orderkey || ')' AS enwiki_title,
  'Q' || (o_orderkey % 7) || '|Q' || (o_orderkey % 5 + 20) AS genre,
  'Q9' || (o_orderkey % 97) AS director, CAST(NULL AS VARCHAR) AS production_company,
  'movie/' || o_orderkey AS metacritic_id, CAST(NULL AS VARCHAR) AS main_subject,
  {v.item_value("P915")} AS filming_location, {v.item_value("P161")} AS cast_member,
  {v.item_value("P179")} AS series, {v.item_value("P144")} AS based_on,
  {v.item_value("P495")} AS country_of_origin, {v.item_value("P364")} AS original_language,
  least({_PARTIAL_SQL}, DATE '2001-12-31') AS publication_date,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice > o_orderkey % 400 * 1000 END AS made_profit,
  o_totalprice AS nbox,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 400 * 1000 AS DOUBLE) END AS ncost
FROM orders
WHERE o_orderkey % 101 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 13 <> 0
  AND o_orderkey % 11 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0"""


def genre_labels(spark, sf_dir):
    slim = materialize(v.entities(spark, sf_dir, ("genre",)), "slim")
    return genre_map(slim)


GENRE_LABELS_SQL = """
WITH used AS (
  SELECT UNNEST(['Q' || (o_orderkey % 7), 'Q' || (o_orderkey % 5 + 20)]) AS wikidata_id
  FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 89 <> 0
)
SELECT DISTINCT wikidata_id, 'Film ' || o_orderkey AS genre_label
FROM used JOIN orders ON wikidata_id = 'Q' || o_orderkey
WHERE o_orderkey % 17 <> 0 AND o_orderkey % 101 <> 0"""


def entity_labels(spark, sf_dir):
    return label_map(v.entities(spark, sf_dir, ()))


ENTITY_LABELS_SQL = """
SELECT 'Q' || o_orderkey AS wikidata_id, 'Film ' || o_orderkey AS label FROM orders
WHERE o_orderkey % 17 <> 0 AND o_orderkey % 101 <> 0"""


def partial_dates(spark, sf_dir):
    text = F.expr(v._TIME)
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("raw"), partial_date(text).alias("parsed")
    )


PARTIAL_DATES_SQL = f"SELECT o_orderkey, {v._TIME} AS raw, {_PARTIAL_SQL} AS parsed FROM orders"


def ratings_join(spark, sf_dir):
    sums = v.written_sums(spark, sf_dir)
    films = complete(v.films(spark, sf_dir, sums), ["nbox", "ncost", "publication_date"])
    rated = join_ratings(films, v.ratings(spark, sf_dir, sums).drop("film_key"))
    rated = complete(well_rated(rated), ["critic_average", "critic_percent"])
    return rated.select(
        "film_key", "rotten_tomatoes_id", "imdb_id_x", "imdb_id_y", "publication_date", "nbox",
        "ncost", "audience_average", "audience_percent", "audience_ratings", "critic_average",
        "critic_percent",
    )


RATED_CTE = (
    FILMS_CTE
    + """,
rated AS (
  SELECT f.film_key, f.rotten_tomatoes_id, f.imdb_id AS imdb_id_x, r.imdb_id AS imdb_id_y,
    f.publication_date, f.nbox, f.ncost, r.audience_average, r.audience_percent,
    r.audience_ratings, r.critic_average, r.critic_percent
  FROM films f JOIN ratings r ON f.rotten_tomatoes_id = r.rotten_tomatoes_id
  WHERE f.ncost IS NOT NULL AND r.audience_ratings >= 40 AND r.critic_average IS NOT NULL
    AND r.critic_percent IS NOT NULL
)"""
)
RATINGS_JOIN_SQL = with_ctes(RATED_CTE, select="SELECT * FROM rated")


def film_chain(spark, sf_dir, leading=None):
    """Films x ratings x found enrichment with credits and awards points.

    With ``leading`` only so many first credits of each film are read, and line items, and orders
    if there are many, are cut to those of films that have a plot before they are grouped and joined.
    """
    if leading is None:
        orders = v.table(spark, sf_dir, "orders")
        credits, sums = v.credits(spark, sf_dir), v.written_sums(spark, sf_dir)
    else:
        orders, cut = v.table(spark, sf_dir, "orders"), v.enriched_orders(spark, sf_dir)
        lines = v.enriched_lines(spark, sf_dir, cut)
        orders = cut if orders.count() > v.MOST_WHOLE else orders
        credits, sums = v.leading_credits(spark, sf_dir, leading, lines), v.line_sums(spark, sf_dir, lines)
    films = v.films(spark, sf_dir, sums, orders)
    company = orders.join(
        v.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(F.col("o_orderkey").alias("film_key"), F.col("c_mktsegment").alias("production_company"))
    enrichment = v.plots(spark, sf_dir).select("imdb_id", F.col("awards").alias("omdb_awards"))
    chain = join_chain(films, v.ratings(spark, sf_dir, sums).drop("film_key"), enrichment)
    return (
        chain.drop("imdb_id", "imdb_id_y")
        .join(credits, "film_key")
        .join(company, "film_key")
        .withColumn("weighted_points", awards_score(F.col("omdb_awards")))
    )


def film_chain_join(spark, sf_dir):
    return film_chain(spark, sf_dir).select(
        "film_key", "imdb_id_x", "omdb_awards", "weighted_points", "production_company",
        _text("cast_member").alias("cast_member"), _text("director").alias("director"),
        _text("genre").alias("genre"), "audience_percent", "critic_percent",
    )


def _sql_points(weights) -> str:
    return " + ".join(
        f"coalesce(TRY_CAST(regexp_extract(awards, '{p}', 1) AS INTEGER), 0) * CAST({w} AS DOUBLE)"
        for p, w in zip(AWARD_PATTERNS, weights)
    )


CHAIN_CTE = (
    f"{FILMS_CTE},{CREDITS_CTE},{PLOTS_CTE}"
    + f""",
chain AS (
  SELECT f.film_key, f.imdb_id AS imdb_id_x, p.awards AS omdb_awards,
    {_sql_points(AWARD_WEIGHTS)} AS weighted_points, cu.c_mktsegment AS production_company,
    c.cast_member, c.director, c.genre, r.audience_percent, r.critic_percent,
    r.audience_average, r.critic_average, r.audience_ratings, f.nbox, f.ncost, f.publication_date
  FROM films f JOIN ratings r ON f.rotten_tomatoes_id = r.rotten_tomatoes_id
  JOIN plots p ON f.imdb_id = p.imdb_id JOIN credits c ON f.film_key = c.film_key
  JOIN orders o ON o.o_orderkey = f.film_key JOIN customer cu ON o.o_custkey = cu.c_custkey
)"""
)
FILM_CHAIN_SQL = with_ctes(
    CHAIN_CTE,
    select="""
SELECT film_key, imdb_id_x, omdb_awards, weighted_points, production_company,
  array_to_string(cast_member, '|') AS cast_member, array_to_string(director, '|') AS director,
  array_to_string(genre, '|') AS genre, audience_percent, critic_percent FROM chain""",
)


def real_money(spark, sf_dir):
    """Well rated films with profit, cost and profit rate in money of the base year."""
    rated = ratings_join(spark, sf_dir).withColumn("year", iso_year(F.col("publication_date")))
    value = money_value(F.col("year"))
    return (
        rated.withColumn("profit", profit(F.col("nbox"), F.col("ncost")) * value)
        .withColumn("corr_ncost", F.col("ncost") * value)
        .withColumn("profit_rate", profit_rate(F.col("profit"), F.col("corr_ncost")))
    )


MONEY_CTE = (
    RATED_CTE
    + """,
valued AS (
  SELECT *, CAST(substr(publication_date, 1, 4) AS INTEGER) AS year,
    pow(1.0297::DOUBLE, 2019 - CAST(substr(publication_date, 1, 4) AS INTEGER)) AS money_value
  FROM rated
),
money AS (
  SELECT *, (nbox - ncost) * money_value AS profit, ncost * money_value AS corr_ncost,
    CASE WHEN ncost <> 0 THEN ((nbox - ncost) * money_value) / (ncost * money_value) END AS profit_rate
  FROM valued
)"""
)


def inflation_profit(spark, sf_dir):
    return real_money(spark, sf_dir).select(
        "film_key", "year", F.round("profit", 2).alias("profit"),
        F.round("corr_ncost", 2).alias("corr_ncost"),
    )


def profit_rates(spark, sf_dir):
    return (
        real_money(spark, sf_dir)
        .filter(F.col("profit_rate") < 500)
        .select("film_key", "year", F.round("profit_rate", 6).alias("profit_rate"))
    )


INFLATION_SQL = with_ctes(
    MONEY_CTE,
    select="SELECT film_key, year, round(profit, 2) AS profit, round(corr_ncost, 2) AS corr_ncost FROM money",
)
PROFIT_RATE_SQL = with_ctes(
    MONEY_CTE,
    select="SELECT film_key, year, round(profit_rate, 6) AS profit_rate FROM money WHERE profit_rate < 500",
)


def awards_points(spark, sf_dir):
    p = v.plots(spark, sf_dir)
    return p.select(
        "film", "awards", awards_score(F.col("awards")).alias("points"),
        awards_score(F.col("awards"), EARLY_AWARD_WEIGHTS).alias("early_points"),
    )


AWARDS_SQL = with_ctes(
    PLOTS_CTE,
    select=f"SELECT film, awards, {_sql_points(AWARD_WEIGHTS)} AS points, "
    f"{_sql_points(EARLY_AWARD_WEIGHTS)} AS early_points FROM plots",
)


def enrich_lookup(spark, sf_dir):
    films = v.films(spark, sf_dir).filter(F.col("imdb_id").startswith("tt"))
    return enrich_films(films, v.answers(spark, sf_dir)).select(
        "imdb_id", _text("omdb_genres").alias("omdb_genres"), "omdb_plot", "omdb_awards"
    )


ENRICH_SQL = with_ctes(
    FILMS_CTE,
    PLOTS_CTE,
    select="""
SELECT f.imdb_id, array_to_string(p.genres, '|') AS omdb_genres, p.plot AS omdb_plot,
  p.awards AS omdb_awards
FROM films f JOIN plots p ON f.imdb_id = p.imdb_id
WHERE starts_with(f.imdb_id, 'tt') AND p.film % 10 <> 9""",
)


def enrich_todo(spark, sf_dir):
    """The JSON length of a film's whole row ranks it; money counts with a fixed number of digits."""
    films = v.films(spark, sf_dir).filter(F.col("imdb_id").startswith("tt")).withColumns(
        {"nbox": F.col("nbox").cast("decimal(18,2)"), "ncost": F.col("ncost").cast("decimal(20,4)")}
    )
    todo = films_to_fetch(films, v.answers(spark, sf_dir), quota=1000)
    return todo.select("imdb_id", "row_len")


ENRICH_TODO_SQL = with_ctes(
    FILMS_CTE,
    PLOTS_CTE,
    select="""
SELECT imdb_id, CAST(length('{"film_key":' || film_key || ',"wikidata_id":"' || wikidata_id
  || '","imdb_id":"' || imdb_id || '"'
  || coalesce(',"rotten_tomatoes_id":"' || rotten_tomatoes_id || '"', '')
  || ',"publication_date":"' || publication_date || '"'
  || coalesce(',"nbox":' || CAST(nbox AS DECIMAL(18,2)), '')
  || coalesce(',"ncost":' || CAST(ncost AS DECIMAL(20,4)), '') || '}') AS INTEGER) AS row_len
FROM films WHERE starts_with(imdb_id, 'tt') AND imdb_id NOT IN (SELECT imdb_id FROM plots)
ORDER BY row_len DESC, imdb_id LIMIT 1000""",
)


def film_profile(spark, sf_dir):
    sums = v.written_sums(spark, sf_dir)
    rated = v.films(spark, sf_dir, sums).join(v.ratings(spark, sf_dir, sums).select(
        "film_key", "audience_percent", "critic_percent"), "film_key", "left")
    return table_profile(rated)


_PROFILE = {
    "film_key": "bigint", "wikidata_id": "string", "imdb_id": "string",
    "rotten_tomatoes_id": "string", "publication_date": "string", "nbox": "double",
    "ncost": "double", "audience_percent": "double", "critic_percent": "double",
}
PROFILE_SQL = with_ctes(
    FILMS_CTE,
    "\nt AS (SELECT f.*, r.audience_percent, r.critic_percent FROM films f LEFT JOIN ratings r USING (film_key))",
    select=" UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, count({n}) AS non_null, count(*) AS n_rows FROM t"
        for i, (n, t) in enumerate(_PROFILE.items())
    ),
)


def film_ranges(spark, sf_dir):
    films = v.films(spark, sf_dir).withColumn("year", iso_year(F.col("publication_date")))
    return value_range(films, ["year", "nbox", "ncost"])


RANGES_SQL = with_ctes(
    FILMS_CTE,
    "\nt AS (SELECT *, CAST(substr(publication_date, 1, 4) AS INTEGER) AS year FROM films)",
    select=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM t"
        for c in ("year", "nbox", "ncost")
    ),
)

QUERIES = {
    "claims_extract": (claims_extract, CLAIMS_EXTRACT_SQL),
    "claims_rejects": (claims_rejects, CLAIMS_REJECTS_SQL),
    "films_select": (films_select, FILMS_SELECT_SQL),
    "genre_map": (genre_labels, GENRE_LABELS_SQL),
    "label_map": (entity_labels, ENTITY_LABELS_SQL),
    "partial_dates": (partial_dates, PARTIAL_DATES_SQL),
    "ratings_join": (ratings_join, RATINGS_JOIN_SQL),
    "film_chain_join": (film_chain_join, FILM_CHAIN_SQL),
    "inflation_profit": (inflation_profit, INFLATION_SQL),
    "profit_rate": (profit_rates, PROFIT_RATE_SQL),
    "awards_score": (awards_points, AWARDS_SQL),
    "enrich_lookup": (enrich_lookup, ENRICH_SQL),
    "enrich_todo": (enrich_todo, ENRICH_TODO_SQL),
    "table_profile": (film_profile, PROFILE_SQL),
    "value_range": (film_ranges, RANGES_SQL),
}
