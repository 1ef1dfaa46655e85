"""Film-shaped inputs derived from the driver tables, in Spark and as SQL CTEs.

No film data is shipped, so orders act as films, line items as their credits and ratings, and
documents as plots. Expressions both engines read the same way are written once, as SQL text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.claims import CLAIM_NAMES, extract_claims, parse_entities
from ..session import broadcast_checked, fresh_path, materialize, spread_rows, spread_small
from ..sources.dump import entity_lines
from ..sources.lexicon import read_lexicon

# Parameters of the registered queries.
MIN_SUPPORT = 100
# Orders of a task that writes dump lines, about 5,000 bytes each.
DUMP_ROWS = 40_000
# Orders that a chain of leading credits joins whole, in the order of their table; more are cut first.
MOST_WHOLE = 200_000
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "with",
)
LEXICON = {
    "the": 1, "is": 1, "with": 1, "work": 1, "best": 1, "lean": 1, "good": 1, "une": 1,
    "und": 1, "of": -1, "in": -1, "that": -1, "for": -1, "der": -1, "les": -1, "el": -1,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _statement(value: str) -> str:
    """SQL text of one claim statement around a SQL text of its JSON value."""
    return (
        """'{"mainsnak":{"snaktype":"value","datavalue":{"value":' || """
        + value
        + """ || '}},"rank":"normal"}'"""
    )


def _claim(code: str, *values: str) -> str:
    inner = " || ',' || ".join(values)
    return f"""'"{code}":[' || {inner} || ']'"""


_NO_VALUE = """'{"mainsnak":{"snaktype":"novalue"}}'"""
_DAY = "CAST(o_orderdate AS DATE)"
_TIME = (
    f"CASE o_orderkey % 4 WHEN 0 THEN '+' || {_DAY} || 'T00:00:00Z' "
    f"WHEN 1 THEN '+' || substr('' || {_DAY}, 1, 7) || '-00T00:00:00Z' "
    f"WHEN 2 THEN '+' || substr('' || {_DAY}, 1, 4) || '-00-00T00:00:00Z' "
    f"ELSE '+' || substr('' || {_DAY}, 1, 4) || '-02-30T00:00:00Z' END"
)
# Item claims that only name another entity: each has its own number and cycle.
ITEM_CLAIMS = "P279 P495 P58 P161 P144 P364 P840 P344 P1040 P915 P179 P725 P1431 P750 P86".split()


def item_value(code: str) -> str:
    """SQL text of the entity that an order's claim names."""
    k = ITEM_CLAIMS.index(code)
    return f"'Q{70 + k}' || (o_orderkey % {5 + k})"


_CLAIMS = " || ',' || ".join(
    [
        *(
            _claim(code, _statement("""'{"id":"' || """ + item_value(code) + """ || '"}'"""))
            for code in ITEM_CLAIMS
        ),
        _claim("P1712", _statement("""'"movie/' || o_orderkey || '"'""")),
        _claim("P3302", _statement("""'"om' || o_orderkey || '"'""")),
        _claim("P31", _statement("""'{"entity-type":"item","id":"Q11424"}'""")),
        _claim("P9999", _statement("""'{"id":"Q1"}'"""), _statement("""'"ignored"'""")),
        _claim(
            "P136",
            _statement("""'{"id":"Q' || (o_orderkey % 7) || '"}'"""),
            _NO_VALUE,
            _statement("""'{"id":"Q' || (o_orderkey % 5 + 20) || '"}'"""),
        ),
        _claim(
            "P577",
            _statement(f"""'{{"time":"' || ({_TIME}) || '","precision":9}}'"""),
            _statement("""'{"time":"+2001-12-31T00:00:00Z","precision":11}'"""),
        ),
        _claim(
            "P2142",
            _statement(
                """'{"amount":"+' || CAST(o_totalprice AS DECIMAL(12,2)) || '","unit":"http://units/entity/Q4917"}'"""
            ),
        ),
        _claim("P1476", _statement("""'{"language":"fr","text":"Titre ' || o_orderkey || '"}'""")),
        _claim("P272", _NO_VALUE),
        _claim("P57", _statement("""'{"id":"Q9' || (o_orderkey % 97) || '"}'""")),
    ]
)
_OPTIONAL = " || ".join(
    [
        "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ',' || "
        + _claim(
            "P345",
            _statement(
                """CASE WHEN o_orderkey % 11 = 0 THEN '"nm' ELSE '"tt' END || o_orderkey || '"'"""
            ),
        )
        + " END",
        "CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE ',' || "
        + _claim("P1258", _statement("""'"m/' || o_orderkey || '"'"""))
        + " END",
        "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ',' || "
        + _claim("P2130", _statement("""'{"amount":"+' || (o_orderkey % 400 * 1000) || '","unit":"1"}'"""))
        + " END",
        "CASE WHEN o_orderkey % 97 = 0 THEN ',' || "
        + _claim("P921", _statement("""'{"latitude":1.5,"longitude":2}'"""))
        + " ELSE '' END",
    ]
)
# One dump line per order: some without label, title or claims, some cut off in the middle.
ENTITY_LINE = (
    "CASE WHEN o_orderkey % 101 = 0 THEN '{\"id\":\"Q' || o_orderkey || '\",\"labels\":,' ELSE "
    "'{\"type\":\"item\",\"id\":\"Q' || o_orderkey || '\",\"labels\":' || "
    "CASE WHEN o_orderkey % 17 = 0 THEN '[]' ELSE '{\"en\":{\"language\":\"en\",\"value\":\"Film ' "
    "|| o_orderkey || '\"}}' END || ',\"sitelinks\":' || "
    "CASE WHEN o_orderkey % 19 = 0 THEN '{}' ELSE '{\"enwiki\":{\"title\":\"Film (' "
    "|| o_orderkey || ')\"}}' END || ',\"claims\":' || "
    f"CASE WHEN o_orderkey % 89 = 0 THEN '[]' ELSE '{{' || {_CLAIMS} || {_OPTIONAL} || '}}' END || "
    "'},' END"
)


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw dump: an opening bracket line, then one JSON object and a comma per line."""
    line = F.expr(ENTITY_LINE)
    lines = F.when(F.col("o_orderkey") == 0, F.array(F.lit("["), line)).otherwise(F.array(line))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return spread_rows(orders, DUMP_ROWS).select(F.explode(lines).alias("value"))


def parsed_dump(spark: SparkSession, sf_dir: str, claims=tuple(CLAIM_NAMES.values())) -> DataFrame:
    return parse_entities(entity_lines(dump_lines(spark, sf_dir)), claims=claims)


def entities(spark: SparkSession, sf_dir: str, claims=tuple(CLAIM_NAMES.values())) -> DataFrame:
    return extract_claims(parsed_dump(spark, sf_dir, claims))


DUMP_CTE = f"""
dump AS (
  SELECT UNNEST(CASE WHEN o_orderkey = 0 THEN ['[', {ENTITY_LINE}] ELSE [{ENTITY_LINE}] END) AS raw
  FROM orders
),
lines AS (SELECT regexp_replace(raw, ',$', '') AS line FROM dump WHERE length(raw) > 1),
parsed AS (
  SELECT line, CASE WHEN json_valid(line) THEN CAST(line AS JSON) END AS j FROM lines
)"""

# Integer sums per order: exact, and the same in any order of addition.
_SUMS = {
    "n": "count(*)",
    "qty": "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)",
    "disc": "CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT)",
    "tax": "CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT)",
    "cost": "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)"
    " * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS BIGINT)",
}
_RATINGS = {
    "film_key": "film_key",
    "rotten_tomatoes_id": "'m/' || film_key",
    "imdb_id": "'tt' || film_key",
    "audience_average": "CAST(floor(CAST(qty AS DOUBLE) / n) AS DOUBLE) / 10",
    "audience_percent": "CAST(floor(CAST(2 * qty AS DOUBLE) / n) AS DOUBLE)",
    "audience_ratings": "CAST(qty AS DOUBLE)",
    "critic_average": "CASE WHEN film_key % 7 = 0 THEN NULL"
    " ELSE CAST(floor(CAST(10 * tax AS DOUBLE) / n) AS DOUBLE) / 10 END",
    "critic_percent": "CASE WHEN film_key % 7 = 0 THEN NULL"
    " ELSE CAST(floor(CAST(10 * disc AS DOUBLE) / n) AS DOUBLE) END",
}
_FILMS = {
    "film_key": "o_orderkey",
    "wikidata_id": "'Q' || o_orderkey",
    "imdb_id": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0"
    " THEN 'nm' || o_orderkey ELSE 'tt' || o_orderkey END",
    "rotten_tomatoes_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'm/' || o_orderkey END",
    "publication_date": f"'' || {_DAY}",
    "nbox": "o_totalprice",
}


def _sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _exprs(columns: dict[str, str]) -> list:
    return [F.expr(e).alias(n) for n, e in columns.items()]


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that are films with a plot, written: all that a chain of films needs of them."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.expr(_FILMS["imdb_id"]).alias("imdb_id")
    )
    plots = table(spark, sf_dir, "documents").select(F.expr("'tt' || doc_id").alias("imdb_id"))
    return materialize(orders.join(plots, "imdb_id", "left_semi").drop("imdb_id"), "enriched")


def enriched_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """The line items of films that have a plot, written; ``orders`` are those films' if at hand."""
    orders = enriched_orders(spark, sf_dir) if orders is None else orders
    keys = orders.select(F.col("o_orderkey").alias("film_key"))
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(broadcast_checked(keys), lines.l_orderkey == keys.film_key, "left_semi")
    return materialize(lines.select(*_ENTRY_ORDER, "l_orderkey", "l_discount", "l_tax"), "enriched-lines")


def line_sums(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Sums per film of all line items, or of ``lines``."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return lines.groupBy(F.col("l_orderkey").alias("film_key")).agg(*_exprs(_SUMS))


def written_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line sums, written once for queries that need both films and ratings."""
    return materialize(line_sums(spark, sf_dir), "line-sums")


def ratings(spark: SparkSession, sf_dir: str, sums: DataFrame | None = None) -> DataFrame:
    """Ratings; ``sums`` are the line sums if they are at hand."""
    return (line_sums(spark, sf_dir) if sums is None else sums).select(*_exprs(_RATINGS))


def films(
    spark: SparkSession, sf_dir: str, sums: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    """Films with money, of all orders or of ``orders``: cost is the discounted value of the line items."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    cost = (line_sums(spark, sf_dir) if sums is None else sums).select(
        "film_key", (F.col("cost").cast("double") / 10000).alias("ncost")
    )
    return orders.select(*_exprs(_FILMS)).join(cost, "film_key", "left")


_ENTRY_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _collected(rows: DataFrame) -> DataFrame:
    """(film_key, cast_member, director, genre): the lists of line items with their parts, in order."""
    entry = F.struct(
        *_ENTRY_ORDER,
        F.concat(F.lit("P"), F.col("l_partkey")).alias("c"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("d"),
        F.col("p_type").alias("g"),
    )
    lists = rows.groupBy(F.col("l_orderkey").alias("film_key")).agg(
        F.sort_array(F.collect_list(entry)).alias("e")
    )
    return lists.select(
        "film_key",
        F.col("e.c").alias("cast_member"),
        F.col("e.d").alias("director"),
        F.col("e.g").alias("genre"),
    )


def _with_parts(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast, directors and genres of each film, one entry per line item, in order."""
    return _collected(_with_parts(spark, sf_dir, table(spark, sf_dir, "lineitem")))


def leading_credits(spark: SparkSession, sf_dir: str, n: int, lines: DataFrame | None = None) -> DataFrame:
    """The first ``n`` entries of each film's credits (T04), from all line items or from ``lines``.

    The rank is taken before the lists are built, and each task drops what cannot be among the
    first ``n`` before it shuffles, so a film with very many line items sends few of them. Parts
    are joined first, as in :func:`credits`: only line items with a part are entries.
    """
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    rows = _with_parts(spark, sf_dir, lines.select("l_orderkey", *_ENTRY_ORDER))
    first = W.partitionBy("l_orderkey").orderBy(*_ENTRY_ORDER)
    ranked = rows.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= n)
    return _collected(ranked.drop("_rank"))


FILMS_CTE = f"""
line_sums AS (SELECT l_orderkey AS film_key, {_sql(_SUMS)} FROM lineitem GROUP BY l_orderkey),
ratings AS (SELECT {_sql(_RATINGS)} FROM line_sums),
film_base AS (SELECT {_sql(_FILMS)} FROM orders),
films AS (
  SELECT f.*, CAST(s.cost AS DOUBLE) / 10000 AS ncost
  FROM film_base f LEFT JOIN line_sums s USING (film_key)
)"""
CREDITS_CTE = """
ranked AS (
  SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem
),
credits AS (
  SELECT l_orderkey AS film_key,
    list('P' || l_partkey ORDER BY rn) AS cast_member,
    list('S' || l_suppkey ORDER BY rn) AS director, list(p_type ORDER BY rn) AS genre
  FROM ranked JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
)"""

_AWARDS = (
    "CASE doc_id % 5 "
    "WHEN 0 THEN 'Won ' || (n_chars % 4) || ' Oscars. Another ' || (n_chars % 11) || ' wins & ' || (n_chars % 17) || ' nominations.' "
    "WHEN 1 THEN 'Nominated for ' || (n_chars % 4) || ' Oscars. Another ' || (n_chars % 11) || ' wins & ' || (n_chars % 17) || ' nominations.' "
    "WHEN 2 THEN 'Won ' || (n_chars % 4) || ' Golden Globes. Another ' || (n_chars % 11) || ' wins.' "
    "WHEN 3 THEN 'Nominated for ' || (n_chars % 4) || ' Golden Globe. Another ' || (n_chars % 17) || ' nominations.' "
    "ELSE 'N/A' END"
)
_GENRE_TEXT = "lang || ', ' || source || coalesce(', q' || quality, '')"


def plots(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """(film, imdb_id, plot, awards, genre_text, genres): one row per document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents")
    docs = (spread_small(docs) if spread else docs).join(labels, "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("film"),
        F.expr("'tt' || doc_id").alias("imdb_id"),
        F.col("text").alias("plot"),
        F.expr(_AWARDS).alias("awards"),
        F.expr(_GENRE_TEXT).alias("genre_text"),
    ).withColumn("genres", F.split("genre_text", ", "))


def plot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(film, plot, genres), spread over all cores for work on the texts."""
    return plots(spark, sf_dir, spread=True).select("film", "plot", "genres")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored answers of the enrichment service, one tenth of them "not found"."""
    payload = F.to_json(
        F.struct(
            F.col("genre_text").alias("Genre"),
            F.col("plot").alias("Plot"),
            F.col("awards").alias("Awards"),
        )
    )
    missing = F.col("film") % 10 == 9
    return plots(spark, sf_dir).select(
        "imdb_id",
        F.when(missing, "notfound").otherwise("ok").alias("status"),
        F.when(~missing, payload).alias("payload"),
    )


PLOTS_CTE = f"""
plots AS (
  SELECT doc_id AS film, 'tt' || doc_id AS imdb_id, text AS plot, {_AWARDS} AS awards,
    {_GENRE_TEXT} AS genre_text, string_split({_GENRE_TEXT}, ', ') AS genres
  FROM documents LEFT JOIN (SELECT doc_id, quality FROM labels) USING (doc_id)
)"""


def lexicon(spark: SparkSession) -> DataFrame:
    """The opinion words, written as two word lists and read back as a lexicon."""
    paths = []
    for polarity in (1, -1):
        paths.append(fresh_path(spark, "opinion-words"))
        words = [(w,) for w, p in LEXICON.items() if p == polarity]
        spark.createDataFrame(words, "word string").coalesce(1).write.text(paths[-1])
    return read_lexicon(spark, *paths)


def stop_words(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{w}')" for w in STOP_WORDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(word)")


LEXICON_CTE = "\nlexicon(word, polarity) AS (VALUES " + ", ".join(
    f"('{w}', {p})" for w, p in LEXICON.items()
) + ")"
STOP_CTE = "\nstop_words(word) AS (VALUES " + ", ".join(f"('{w}')" for w in STOP_WORDS) + ")"


def with_ctes(*parts: str, select: str) -> str:
    """A SQL query from CTE texts and its final select."""
    body = reduce(lambda a, b: f"{a},{b}", parts)
    return f"WITH {body.strip()}\n{select.strip()}"
