import itertools
import random
import zlib

import numpy as np
import pytest

from filmlake.llm import language as lang

SF_DIR = "/root/testdata/sf0.01"


def by_all_paths(scores, steps, starts):
    """Marginals of one sequence by the sum over every labelling."""
    n, k = scores.shape
    found = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        value = starts[path[0]] + sum(scores[t, c] for t, c in enumerate(path))
        value = np.exp(value + sum(steps[a, b] for a, b in zip(path, path[1:])))
        for t, c in enumerate(path):
            found[t, c] += value
    return found / found.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("sizes", [[1], [6], [1, 1, 1], [3, 5, 2, 6, 1, 4]])
def test_forward_backward_against_all_paths(sizes):
    draw = np.random.default_rng(len(sizes))
    steps, starts = draw.normal(size=(3, 3)), draw.normal(size=3)
    parts = [draw.normal(size=(n, 3)) * 2 for n in sizes]
    first = np.concatenate([[True] + [False] * (n - 1) for n in sizes])
    got = lang.probabilities(np.concatenate(parts), first, steps, starts)
    assert np.allclose(got, np.concatenate([by_all_paths(p, steps, starts) for p in parts]))


def test_long_sequences_and_far_scores_stay_finite():
    draw = np.random.default_rng(0)
    scores = draw.normal(size=(50_000, 4)) * 300
    first = np.zeros(len(scores), bool)
    first[[0, 17, 40_000]] = True
    got = lang.probabilities(scores, first, draw.normal(size=(4, 4)) * 5, np.zeros(4))
    assert np.isfinite(got).all() and np.allclose(got.sum(axis=1), 1)
    assert lang.probabilities(np.zeros((0, 4)), np.zeros(0, bool), np.zeros((4, 4)), np.zeros(4)).shape == (0, 4)


def test_gradient_of_transitions_makes_words_stick():
    passages = [(name, [word] * 60) for name, word in (("x", "kuku"), ("y", "lolo")) for _ in range(6)]
    field = lang.train(passages)
    assert field.steps[0, 0] > field.steps[0, 1] and field.steps[1, 1] > field.steps[1, 0]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def field(documents):
    return lang.fit(documents)


def test_held_out_accuracy(documents, field):
    rows = lang.predict(documents.select("doc_id", "lang", "text"), field, ("doc_id", "lang")).collect()
    assert len(rows) == documents.count()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 250 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_text(spark, documents, field):
    texts = {r.lang: r.text.split()[:30] for r in documents.filter("doc_id % 3 = 0 and n_chars > 600").collect()}
    words = texts["en"] + texts["fr"] + texts["en"]
    frame = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    found = lang.spans(frame, field).first().spans
    total = {}
    for s in found:
        total[s.language] = total.get(s.language, 0) + s.words
    assert total["en"] > 45 and total["fr"] > 20 and max(s.words for s in found if s.language == "fr") > 10
    assert lang.predict(frame, field).first().lang_pred == "en"


def test_texts_without_letters_nulls_and_other_columns(spark, field):
    texts = [None, "", "12 -- 3 \n", "— … “”", "東京", "THE the The", "the" * 30_000, "é", "The"]
    rows = [(k if k else None, "z", 1.5, "x", t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, lang_pred string, score double, spans string, text string")
    got = {r.doc_id or 0: r for r in lang.predict(docs, field).collect()}
    assert len(got) == len(texts)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in range(4))
    assert all(got[k].lang_pred in field.languages and got[k].score > 0 for k in range(4, len(texts)))
    assert got[5].lang_pred == got[8].lang_pred == "en"
    assert lang.spans(docs, field).filter("size(spans) = 0").count() == 4
    assert lang.predict(docs.limit(0), field).count() == 0


def test_nothing_or_one_language_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    none = spark.createDataFrame([(1, "some words", None), (None, "a", "en"), (2, None, "en")], schema)
    field = lang.fit(none)
    assert field.languages == [] and {r.lang_pred for r in lang.predict(none, field).collect()} == {"und"}
    one = spark.createDataFrame([(k, "some words", "en") for k in range(20)], schema)
    found = lang.predict(one, lang.fit(one)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("en", 1.0)}


def test_folds_and_labels_stay_out(spark, documents, field):
    """Other labels in fold 1, and other sources, change nothing that is learnt."""
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(lang.fold() == 1, F.lit("xx")).otherwise(F.col("lang")))
    again = lang.fit(changed.withColumn("source", F.lit("other")))
    assert again.languages == field.languages and np.allclose(again.weights, field.weights)


def test_a_hot_text_does_not_fill_the_sample(spark):
    draw = random.Random(1)
    word = lambda letters: "".join(draw.choices(letters, k=5))
    rows = [(k, " ".join(word("abcde") for _ in range(30)), "p") for k in range(60)]
    rows += [(100 + k, " ".join(word("stuvw") for _ in range(30)), "q") for k in range(60)]
    rows += [(1000 + k, "hot hot", "p") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang.predict(docs.select("doc_id", "lang", "text"), lang.fit(docs, fit_texts=40), ("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= len(got) - 3
