"""Film enrichment from a table of already fetched answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import split_labels

FOUND, NOT_FOUND = "ok", "notfound"
PAYLOAD_SCHEMA = "Genre string, Plot string, Awards string"


def enrich_films(films: DataFrame, answers: DataFrame) -> DataFrame:
    """Genres, plot and awards of each film with a stored answer.

    A stored "not found" counts as no answer. The status test sits on the answers, so only
    useful payloads are shuffled, and the payload is parsed after the join.
    """
    found = answers.filter(F.col("status") == FOUND).select("imdb_id", "payload")
    joined = films.select("imdb_id").join(found, "imdb_id")
    p = F.from_json("payload", PAYLOAD_SCHEMA)
    return joined.select("imdb_id", p.alias("p")).filter(F.col("p").isNotNull()).select(
        "imdb_id",
        split_labels(F.col("p.Genre")).alias("omdb_genres"),
        F.col("p.Plot").alias("omdb_plot"),
        F.col("p.Awards").alias("omdb_awards"),
    )


def films_to_fetch(films: DataFrame, answers: DataFrame, quota: int, size=None) -> DataFrame:
    """The next films to ask for: no stored answer of any kind, longest rows first.

    ``size`` is the ranking expression, by default the JSON length of the row. Sort and limit
    run as one top-k: each task keeps at most ``quota`` rows.
    """
    size = F.length(F.to_json(F.struct(*films.columns))) if size is None else size
    return (
        films.withColumn("row_len", size.cast("int"))
        .join(answers.select("imdb_id"), "imdb_id", "left_anti")
        .orderBy(F.col("row_len").desc(), "imdb_id")
        .limit(quota)
    )
