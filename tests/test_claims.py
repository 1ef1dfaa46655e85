import json

from filmlake.operators.claims import CLAIM_NAMES, claim_rejects, extract_claims, parse_entities
from filmlake.operators.films import genre_map, label_map, select_films
from filmlake.sources.dump import entity_lines


def entity(qid, claims=None, **extra):
    body = {
        code: [{"mainsnak": {"datavalue": {"value": v}} if v is not None else {}} for v in values]
        for code, values in (claims or {}).items()
    }
    return json.dumps({"id": qid, **extra, "claims": body})


LINES = [
    "[",
    entity(
        "Q1",
        {
            "P345": ["tt0001"],
            "P136": [{"id": "Q5", "numeric-id": 5}, None, {"id": "Q6"}],
            "P1476": [{"text": "Foo", "language": "en"}],
            "P577": [{"time": "+2001-00-00T00:00:00Z"}, {"time": "+1999-05-00T00:00:00Z"}],
            "P2142": [{"amount": "+5", "unit": "http://x/entity/Q9"}],
            "P2130": [{"amount": "+7", "unit": "1"}],
            "P1258": ["m/a"],
            "P272": [None],
            "P9": ["ignored"],
        },
        labels={"en": {"value": "One"}, "fr": {"value": "Un"}},
        sitelinks={"enwiki": {"title": "One (film)"}},
    )
    + ",",
    '{"id":"Q5","labels":{"en":{"value":"drama"}},"claims":[]},',
    entity("Q3", {"P921": [{"latitude": 1.0}, {"id": "Q1"}], "P345": ["nm1"]}) + ",",
    '{"id":"Q4","labels":',
    entity("Q6", {"P1476": ['{"id":"text"}']}, labels=[]),
    "]",
]


def parsed(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    return parse_entities(entity_lines(lines))


def test_lines_lose_brackets_and_commas(spark):
    lines = spark.createDataFrame([("[",), ('{"a":1},',), ('{"b":",,"}',), ("]",)], "value string")
    assert [r.value for r in entity_lines(lines).collect()] == ['{"a":1}', '{"b":",,"}']


def test_extract(spark):
    slim = extract_claims(parsed(spark))
    assert set(slim.columns) == {"id", "label", "enwiki_title", *CLAIM_NAMES.values()}
    got = {r.id: r for r in slim.collect()}
    assert set(got) == {"Q1", "Q3", "Q5", "Q6"}
    q1 = got["Q1"]
    assert (q1.label, q1.enwiki_title) == ("One", "One (film)")
    assert q1.imdb_id == ["tt0001"] and q1.genre == ["Q5", "Q6"] and q1.title == ["Foo"]
    assert q1.publication_date[0] == "+2001-00-00T00:00:00Z"
    assert [tuple(x) for x in q1.box_office] == [("+5", "Q9")]
    assert [tuple(x) for x in q1.cost] == [("+7", "1")]
    assert q1.production_company is None
    assert got["Q3"].main_subject == ["Q1"]
    assert got["Q5"].label == "drama" and got["Q5"].genre is None
    assert got["Q6"].title == ['{"id":"text"}']


def test_rejects(spark, rows):
    assert rows(claim_rejects(parsed(spark))) == [
        (None, None, '{"id":"Q4","labels":'),
        ("Q3", "P921", '{"latitude":1}'),
    ]


def test_films_and_maps(spark, rows):
    slim = extract_claims(parsed(spark))
    films = select_films(slim).collect()
    assert len(films) == 1
    film = films[0]
    assert film.wikidata_id == "Q1" and film.imdb_id == "tt0001"
    assert str(film.publication_date) == "1999-05-01"
    assert (film.nbox, film.ncost, film.made_profit) == (5.0, 7.0, False)
    assert rows(label_map(slim)) == [("Q1", "One"), ("Q5", "drama")]
    assert rows(genre_map(slim)) == [("Q5", "drama")]


def test_row_local_operators_accept_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(source)
    stream = spark.readStream.text(source)
    query = (
        extract_claims(parse_entities(entity_lines(stream)))
        .select("id", "label")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    assert {r.id for r in spark.read.parquet(sink).collect()} == {"Q1", "Q3", "Q5", "Q6"}
