"""Films, genre map and label map from the slim entity table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import earliest_date
from ..functions.lists import first_item
from ..functions.money import made_profit
from ..session import broadcast_checked, materialize


def select_films(entities: DataFrame) -> DataFrame:
    """Entities that are films with a genre, a title page and a ratings id.

    The filters come before every derived column, so the null checks reach a Parquet scan.
    """
    c = F.col
    films = entities.filter(
        c("imdb_id").isNotNull()
        & c("genre").isNotNull()
        & c("enwiki_title").isNotNull()
        & c("rotten_tomatoes_id").isNotNull()
        & first_item(c("imdb_id")).startswith("tt")
    )

    def amount(name):
        return first_item(c(name))["amount"].try_cast("double")

    def first(name):
        return first_item(c(name)).alias(name)

    return films.select(
        c("id").alias("wikidata_id"),
        "label",
        first("imdb_id"),
        first("rotten_tomatoes_id"),
        first("metacritic_id"),
        "enwiki_title",
        "genre",
        "main_subject",
        "filming_location",
        "director",
        "cast_member",
        first("series"),
        first("production_company"),
        earliest_date(c("publication_date")).alias("publication_date"),
        first("based_on"),
        first("country_of_origin"),
        first("original_language"),
        made_profit(amount("box_office"), amount("cost")).alias("made_profit"),
        amount("box_office").alias("nbox"),
        amount("cost").alias("ncost"),
    )


def label_map(entities: DataFrame) -> DataFrame:
    """(wikidata_id, label) of every labelled entity."""
    return entities.filter(F.col("label").isNotNull()).select(
        F.col("id").alias("wikidata_id"), "label"
    )


def genre_map(entities: DataFrame) -> DataFrame:
    """Labels of the genre ids in use.

    The distinct ids are written once; they are broadcast against the wide label scan only if
    that small table proves small.
    """
    genres = materialize(
        entities.select(F.explode("genre").alias("wikidata_id")).distinct(), "genre-ids"
    )
    labels = label_map(entities)
    return labels.join(broadcast_checked(genres), "wikidata_id").select(
        "wikidata_id", F.col("label").alias("genre_label")
    )
