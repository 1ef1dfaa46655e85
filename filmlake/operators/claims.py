"""Raw entity documents to the slim typed entity table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The claim codes that are kept, and their column names.
CLAIM_NAMES = {
    "P31": "instance_of",
    "P279": "subclass_of",
    "P1476": "title",
    "P921": "main_subject",
    "P136": "genre",
    "P495": "country_of_origin",
    "P577": "publication_date",
    "P57": "director",
    "P58": "screenwriter",
    "P161": "cast_member",
    "P2142": "box_office",
    "P2130": "cost",
    "P345": "imdb_id",
    "P1258": "rotten_tomatoes_id",
    "P1712": "metacritic_id",
    "P3302": "omdb_id",
    "P144": "based_on",
    "P364": "original_language",
    "P840": "narrative_location",
    "P344": "director_of_photography",
    "P1040": "film_editor",
    "P915": "filming_location",
    "P179": "series",
    "P725": "voice_actor",
    "P1431": "executive_producer",
    "P86": "composer",
    "P272": "production_company",
    "P750": "distributor",
}
QUANTITY_COLUMNS = ("box_office", "cost")

_STATEMENTS = "array<struct<mainsnak:struct<datavalue:struct<value:variant>>>>"


def entity_schema(claims: Sequence[str]) -> str:
    """Schema of a document with only the wanted paths.

    The JSON reader skips everything else, and each polymorphic value stays a VARIANT. A part
    of another shape (an empty `claims` written as []) reads as NULL without losing the rest.
    """
    fields = ", ".join(f"{code}:{_STATEMENTS}" for code, n in CLAIM_NAMES.items() if n in claims)
    return (
        "id string, labels struct<en:struct<value:string>>, "
        f"sitelinks struct<enwiki:struct<title:string>>, claims struct<{fields}>"
    )


def parse_entities(
    lines: DataFrame, column: str = "value", claims: Sequence[str] = tuple(CLAIM_NAMES.values())
) -> DataFrame:
    """(line, id, labels, sitelinks, claims); the id is NULL on unreadable lines.

    ``claims`` names the claims worth reading. The parsed struct is unpacked by a generator,
    so that a later filter on the id cannot be pushed below it and parse the line again.
    """
    entity = F.from_json(column, entity_schema(claims))
    return lines.select(F.col(column).alias("line"), F.inline(F.array(entity)))


_MEMBERS = "struct<id string, text string, time string, amount string, unit string>"


def _opened(statements: Column) -> Column:
    """Per statement the raw value ``v`` and its known members ``m``, read in one cast."""

    def entry(s):
        value = s["mainsnak"]["datavalue"]["value"]
        return F.struct(value.alias("v"), F.try_variant_get(value, "$", _MEMBERS).alias("m"))

    return F.transform(statements, entry)


def _text(x: Column) -> Column:
    """Plain text of an opened value: its id, text, time or amount, or itself; NULL if unknown."""
    m, v = x["m"], x["v"]
    plain = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.when(m.isNull(), plain).otherwise(
        F.coalesce(m["id"], m["text"], m["time"], m["amount"])
    )


def _quantity(x: Column) -> Column:
    """(amount, unit) of an opened value, the unit cut to the part after its last slash."""
    amount, unit = x["m"]["amount"], x["m"]["unit"]
    return F.when(
        amount.isNotNull(),
        F.struct(amount.alias("amount"), F.element_at(F.split(unit, "/"), -1).alias("unit")),
    )


def claim_values(statements: Column, quantity: bool = False) -> Column:
    """Values of one claim as a list (P03); absent and unknown values are skipped."""
    read = _quantity if quantity else _text
    return F.filter(F.transform(_opened(statements), read), lambda v: v.isNotNull())


def unknown_values(statements: Column, quantity: bool = False) -> Column:
    """JSON text of the values of one claim that have no known shape."""
    read = _quantity if quantity else _text
    odd = F.filter(_opened(statements), lambda x: x["v"].isNotNull() & read(x).isNull())
    return F.transform(odd, lambda x: F.to_json(x["v"]))


def _read_claims(parsed: DataFrame) -> dict[str, str]:
    present = set(parsed.schema["claims"].dataType.names)
    return {code: name for code, name in CLAIM_NAMES.items() if code in present}


def extract_claims(parsed: DataFrame) -> DataFrame:
    """The slim entity table: id, label, title and 28 named claims.

    Narrow projections only: no explode, no shuffle. A claim without a usable value is NULL;
    that test is a projection of its own, so each list is built once.
    """
    names = _read_claims(parsed)
    read = parsed.filter(F.col("id").isNotNull()).select(
        "id",
        F.col("labels.en.value").alias("label"),
        F.col("sitelinks.enwiki.title").alias("enwiki_title"),
        *[
            claim_values(F.col(f"claims.{code}"), name in QUANTITY_COLUMNS).alias(name)
            for code, name in names.items()
        ],
    )
    return read.withColumns({n: F.when(F.size(n) > 0, F.col(n)) for n in names.values()})


def claim_rejects(parsed: DataFrame) -> DataFrame:
    """What the extraction could not use, as (id, claim, detail) rows.

    An unreadable line gives one row with the line; a value of unknown shape gives one row
    with its JSON text, while the rest of its entity is kept.
    """

    def unknown(code: str, name: str) -> Column:
        return F.transform(
            unknown_values(F.col(f"claims.{code}"), name in QUANTITY_COLUMNS),
            lambda text: F.struct(F.lit(code).alias("claim"), text.alias("detail")),
        )

    empty = F.array().cast("array<struct<claim:string,detail:string>>")
    found = F.concat(
        *[F.coalesce(unknown(code, name), empty) for code, name in _read_claims(parsed).items()]
    )
    bad_line = F.array(
        F.struct(F.lit(None).cast("string").alias("claim"), F.col("line").alias("detail"))
    )
    reason = F.when(F.col("id").isNull(), bad_line).otherwise(found)
    return parsed.select("id", F.explode(reason).alias("r")).select(
        "id", "r.claim", "r.detail"
    )
