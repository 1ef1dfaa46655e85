"""JSON-lines and Parquet tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILMS_SCHEMA = (
    "wikidata_id string, label string, imdb_id string, rotten_tomatoes_id string, "
    "metacritic_id string, enwiki_title string, genre array<string>, main_subject array<string>, "
    "filming_location array<string>, director array<string>, cast_member array<string>, "
    "series string, production_company string, publication_date string, based_on string, "
    "country_of_origin string, original_language string, made_profit boolean, "
    "nbox double, ncost double"
)
RATINGS_SCHEMA = (
    "rotten_tomatoes_id string, imdb_id string, audience_average double, "
    "audience_percent double, audience_ratings double, critic_average double, "
    "critic_percent double"
)
ENRICHMENT_SCHEMA = (
    "imdb_id string, omdb_genres array<string>, omdb_plot string, omdb_awards string"
)


def read_json_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON-lines scan with a declared schema, so no inference pass runs.

    ``path`` may be a folder of part files; NaN in a double column becomes NULL.
    """
    df = spark.read.schema(schema).json(path)
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None).cast("double")).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_json_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Gzip JSON-lines sink.

    ``files`` shuffles to that many files; it does not shrink the parallelism of the plan
    above it. ``files=1`` is meant for results known to be small.
    """
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("compression", "gzip").json(path)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan."""
    return spark.read.parquet(path)


def write_parquet_table(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Parquet sink, overwriting."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
