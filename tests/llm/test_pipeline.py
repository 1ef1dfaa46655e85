import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from filmlake.llm import exact, ngram_join, pii, quality  # noqa: E402
from filmlake.session import materialize  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = source = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == source.columns
        tables.append(docs)
    first, good, single, far, clean = (
        {r.doc_id: r for r in table.collect()} for table in tables
    )
    accepted = {r.doc_id for r in quality.score(source, quality.fit(source)).collect() if r.accepted}
    assert set(good) == accepted
    plain = lambda text: re.sub(r"[\x20\x09-\x0D]+", " ", text)
    assert len(single) == len({plain(r.text) for r in good.values()})
    assert set(single) <= set(good) and all(single[i] == good[i] for i in single)
    classes = ngram_join.classes(tables[2]).collect()
    assert set(far) == {r.doc_id for r in classes if r.first} == {r.class_id for r in classes}
    assert set(clean) == set(far)
    for i, row in clean.items():
        if not pii_pattern(spark, far[i].text):
            assert row == far[i]
        else:
            assert row.text != far[i].text and row.n_chars == len(row.text)


def pii_pattern(spark, text):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(pii.mentions(frame["text"]).alias("m")).first().m


def test_the_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_stages_take_odd_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "Ab cd. " * 20_000, None, "s", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for part in (rows, []):
        docs = materialize(spark.createDataFrame(part, schema), "odd")
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), name.replace(" ", "-"))
    assert exact.keep_first(spark.createDataFrame(rows, schema)).count() == 2
