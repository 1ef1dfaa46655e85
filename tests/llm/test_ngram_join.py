import random

import pytest

from filmlake.llm import ngram_join
from filmlake.llm.shingles import shingle_sets


def brute(rows, threshold=0.8):
    texts = [t or "" for _, t in rows]
    sets = [set(s.tolist()) for s in shingle_sets(texts)]
    n = len(rows)
    near = [
        [
            j
            for j in range(n)
            if j != i
            and (
                len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold
                if sets[i] and sets[j]
                else texts[i] == texts[j]
            )
        ]
        for i in range(n)
    ]
    group = list(range(n))
    for i in range(n):
        todo = [i]
        while todo:
            for j in near[todo.pop()]:
                if group[j] > group[i]:
                    group[j] = group[i]
                    todo.append(j)
    order = lambda k: (rows[k][0] is None, rows[k][0] or 0)
    best = {g: min((k for k in range(n) if group[k] == g), key=order) for g in set(group)}
    return [(rows[k][0], rows[best[group[k]]][0], len(near[k])) for k in range(n)]


def corpus():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    rows = [(None, None), (1, ""), (2, "..."), (3, "two words"), (4, "Two, words!"), (5, "no")]
    for _ in range(12):
        base = [word() for _ in range(draw.choice([12, 60, 300]))]
        for _ in range(draw.choice([1, 3, 8])):
            copy = [w if draw.random() > 0.02 else word() for w in base]
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(base)))
        rows.append((len(rows), " ".join(base)))
    rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("block_grams", [300_000, 500])
def test_against_brute_force(spark, block_grams):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, node int")
    got = ngram_join.classes(docs, block_grams=block_grams)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got.collect()), key=str) == sorted(
        brute(rows), key=str
    )
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == got.filter("first").count() == len({str(x) for x in _classes(got)})


def _classes(got):
    # Null identifiers and repeated rows aside, a class is its smallest identifier.
    return [r.class_id for r in got.filter("first").collect()]


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.999, 128)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.999, 4)


def test_an_empty_table(spark):
    assert ngram_join.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
