"""Write-and-read-back round trips of every source and sink, in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..operators.claims import extract_claims, parse_entities
from ..operators.genres import genre_counts
from ..session import fresh_path
from ..sources.dump import entity_lines, read_dump, reshard_dump
from ..sources.lexicon import read_word_list
from ..sources.tables import (
    read_json_table,
    read_parquet_table,
    write_json_table,
    write_parquet_table,
)
from . import views as v
from .table_queries import CLAIMS_EXTRACT_SQL, FILMS_SELECT_SQL, films_select, shown_claims
from .views import DUMP_CTE, FILMS_CTE, PLOTS_CTE, with_ctes

# Text of one gzip shard: small enough to be read as one task.
SHARD_BYTES = 64 << 20

_FILM_FIELDS = (
    "film_key long, wikidata_id string, imdb_id string, rotten_tomatoes_id string, "
    "publication_date string, nbox double, ncost double"
)


def json_round_trip(spark, sf_dir):
    path = fresh_path(spark, "films-json")
    write_json_table(v.films(spark, sf_dir), path)
    return read_json_table(spark, path, _FILM_FIELDS)


JSON_SQL = with_ctes(
    FILMS_CTE,
    select="SELECT film_key, wikidata_id, imdb_id, rotten_tomatoes_id, publication_date, nbox, ncost FROM films",
)


def json_single_file(spark, sf_dir):
    """A small result, the genre counts, as one gzip JSON file, found again by its folder."""
    path = fresh_path(spark, "genres-json")
    write_json_table(genre_counts(v.plots(spark, sf_dir)), path, files=1)
    return read_json_table(spark, path, "genre string, n long")


JSON_SINGLE_SQL = with_ctes(
    PLOTS_CTE,
    "\ng AS (SELECT UNNEST(genres) AS genre FROM plots)",
    select="SELECT genre, count(*) AS n FROM g GROUP BY genre",
)


def parquet_round_trip(spark, sf_dir):
    path = fresh_path(spark, "films-parquet")
    write_parquet_table(films_select(spark, sf_dir), path)
    return read_parquet_table(spark, path)


def dump_reshard(spark, sf_dir):
    """The dump re-sharded into gzip text files, scanned and cleaned again."""
    path = fresh_path(spark, "shards")
    reshard_dump(v.dump_lines(spark, sf_dir), path, target_bytes=SHARD_BYTES)
    return entity_lines(read_dump(spark, path)).select(F.col("value").alias("line"))


RESHARD_SQL = with_ctes(DUMP_CTE, select="SELECT line FROM lines")


def slim_json_round_trip(spark, sf_dir):
    """Slim entities through gzip JSON lines, read back with a declared schema."""
    path = fresh_path(spark, "slim")
    slim = extract_claims(parse_entities(entity_lines(v.dump_lines(spark, sf_dir))))
    write_json_table(slim, path)
    return shown_claims(read_json_table(spark, path, slim.schema))


def word_list_round_trip(spark, sf_dir):
    """All distinct plot words written and read as a list in UTF-8."""
    path = fresh_path(spark, "words")
    words = v.plots(spark, sf_dir).select(F.explode(word_tokens(F.col("plot"))).alias("word")).distinct()
    words.write.text(path)
    return read_word_list(spark, path, "UTF-8")


WORD_LIST_SQL = with_ctes(
    PLOTS_CTE,
    "\nw AS (SELECT DISTINCT UNNEST(regexp_extract_all(lower(plot), '([\\p{L}\\p{N}_]+)', 1)) AS word FROM plots)",
    select="SELECT word FROM w",
)

QUERIES = {
    "json_round_trip": (json_round_trip, JSON_SQL),
    "json_single_file": (json_single_file, JSON_SINGLE_SQL),
    "parquet_round_trip": (parquet_round_trip, FILMS_SELECT_SQL),
    "dump_reshard": (dump_reshard, RESHARD_SQL),
    "slim_json_round_trip": (slim_json_round_trip, CLAIMS_EXTRACT_SQL),
    "word_list_round_trip": (word_list_round_trip, WORD_LIST_SQL),
}
