import duckdb
import numpy as np

from filmlake.llm import quality

SF = "/root/testdata/sf0.1"


def test_em_finds_the_accuracies():
    draw = np.random.default_rng(4)
    good = draw.random(20_000) < 0.8
    miss = [0.05, 0.2, 0.3, 0.1]
    rows = []
    for y in good:
        rows.append("".join("-" if not y and draw.random() > m else "0" for m in miss))
    patterns = sorted(set(rows))
    prior, table, posterior = quality.fit_labellers(patterns, np.array([rows.count(p) for p in patterns], float))
    assert abs(prior - 0.8) < 0.03
    assert all(abs(table[k, 0, 0] - (1 - m)) < 0.05 for k, m in enumerate(miss))
    assert posterior[patterns.index("0000")] > 0.9 > 0.1 > posterior[patterns.index("----")]


def test_agrees_with_labels_it_has_not_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs)
    assert min(model.accuracy().values()) > 0.8
    got = {r.doc_id: r.accepted for r in quality.score(docs, model).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    bad = [got[i] for i, q in labels if q == 0]
    fine = [got[i] for i, q in labels if q == 1]
    assert 1 - np.mean(bad) > 0.9 and np.mean(fine) > 0.99


def test_edges(spark):
    rows = [(None, None), (1, ""), (2, " \n"), (3, "fine short text."), (3, "fine short text."), (4, "a " * 90_000), (5, "The cat sat on the mat and the dog is in the house of the man. " * 3)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, score string")
    model = quality.fit(docs)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.accepted for r in got if r.doc_id in (None, 1, 2)] == [False] * 3
    kept = quality.keep_accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.accepted for r in got)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.fit(docs) is None
    assert quality.score(docs, None).count() == 0


def test_the_form_of_a_long_word_is_that_of_the_whole():
    forms = quality.Forms()
    clean = "文。" * 40
    assert forms[clean + "$%&#" * 30] != forms[clean] and forms["$%&#" * 30 + clean] != forms["$%&#" * 30]
    assert forms["ab-" * 30 + "x9!"].endswith("a9!") and len(forms) == 0
    ends = quality.LABELLERS.index(quality.word_ends)
    read = lambda last: quality.votes(quality.Reading(" ".join(["文。" * 40 + last] * 5), forms))[ends]
    assert (read("文。"), read("文"), read("#")) == ("-", "+", "-")
    cells = quality.Cells()
    assert cells[("a" * 500, "b")] != cells[("a" * 500, "c")] and cells["a", "b"] == cells["a", "b"] and len(cells) == 1
