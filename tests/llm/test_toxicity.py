import zlib

import numpy as np
import pytest

from filmlake.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    got = queries.toxicity_trees(spark, SF).toPandas()
    assert got.doc_id.is_unique and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    both = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got[got.held_out], on="doc_id")
    hit = both[both.toxic == 1].predicted.mean()
    false = both[both.toxic == 0].predicted.mean()
    assert hit > 0.8 and false < 0.01


def test_features():
    lexicon = toxicity.Lexicon(frozenset({"idiot"}), frozenset({"lowe"}))
    marks = toxicity._Marks(lexicon)
    named = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! an 1d1ot, loweish sooo bad", marks), strict=True))
    assert named["lexicon_density"] == 1 / 7 and named["prefix_density"] == 1 / 7
    assert named["obfuscated_hits"] == 1 / 7 and named["stretching"] == 1 / 7
    assert named["near_second_person"] > named["second_person"] > 0 and named["capitals"] == 1 / 7
    assert toxicity.features("", marks) == [0.0] * len(toxicity.FEATURES)


def test_labels_of_fold_one_are_not_read(spark):
    docs = spark.createDataFrame([(k, "w" * (k % 5 + 1)) for k in range(60)], "doc_id long, text string")
    ones = [(k, 1 if zlib.crc32(str(k).encode()) % 3 == 1 else 0) for k in range(60)]
    model = toxicity.fit(docs, spark.createDataFrame(ones, "doc_id long, toxic int"))
    assert model.trees is None and model.rate == 0.0


def test_edges(spark):
    docs = spark.createDataFrame(
        [(None, None, 1.0), (1, "", 1.0), (2, "a b", 1.0), (2, "a b", 1.0), (3, "z " * 60_000, 1.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0
    assert np.isfinite([r.score for r in got]).all()


def test_words_are_found_in_joined_ones():
    lexicon = toxicity.Lexicon(frozenset({"idiot"}), frozenset({"stup"}))
    at = toxicity.FEATURES.index
    for text in ("idiot here now", "l'idiot here now", "a/idiot here now", "stupid-idiot here now", "(my_idiot) here now"):
        found = toxicity.features(text, toxicity._Marks(lexicon))
        assert found[at("lexicon_density")] == pytest.approx(1 / 3), text
    found = toxicity.features("all-stupid here now you're", toxicity._Marks(lexicon))
    assert found[at("prefix_density")] == found[at("second_person")] == 0.25
    for text in ("idiotic here", "idio-t here", "", "--- '"):
        assert toxicity.features(text, toxicity._Marks(lexicon))[at("lexicon_density")] == 0
