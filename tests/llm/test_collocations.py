import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filmlake.llm import collocations
from filmlake.llm.words import split_words


def brute(rows, top, least, longest):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every piece."""
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        of = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, of in counts.items():
        chosen = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        scored = []
        for phrase, a in chosen.items():
            k = len(phrase)
            inside = lambda q: any(q[i : i + k] == phrase for i in range(len(q) - k + 1))  # noqa: E731, B023
            if any(100 * b >= 50 * a for q, b in chosen.items() if len(q) > k and inside(q)):
                continue
            cuts = [(10**6 * a * a // (of[phrase[:c]] * of[phrase[c:]]), c) for c in range(1, k)]
            score, cut = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), of[phrase[:cut]], of[phrase[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def corpus():
    draw = random.Random(3)
    words = ["a", "B", "é", "the", "cat's", "x_y", "1", "日本"]
    rows = [(None, None), ("en", ""), ("en", " \t.,\n"), ("fr", "Z"), (None, "A b c. " * 12)]
    for _ in range(60):
        text = "".join(
            draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ", ", " the cat's "])
            for _ in range(draw.randint(0, 60))
        )
        rows.append((draw.choice(["en", "en", "de"]), text))
    return rows + rows[:20] + [("en", "the cat's B " * 3000)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("sent", [collocations.MOST_SENT, 0])
@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_brute_force(spark, rows, monkeypatch, sent, longest):
    monkeypatch.setattr(collocations, "RUN_CHARS", 300)
    monkeypatch.setattr(collocations, "MOST_BELOW", sent)
    data = corpus()
    docs = spark.createDataFrame(data, "lang string, text string").repartition(3)
    got = collocations.collocations(docs, top=25, least=4, longest=longest, most_sent=sent)
    assert got.columns == COLUMNS
    want = brute(data, 25, 4, longest)
    assert rows(got) == sorted(want, key=lambda t: tuple(map(str, t))) and want


def test_no_rows_other_columns_and_nothing_frequent(spark):
    names = "run long, words string, gaps int, w0 long, f int, Lang2 string, text string, lang string"
    empty = spark.createDataFrame([], names)
    assert collocations.collocations(empty).columns == COLUMNS and not collocations.collocations(empty).count()
    few = spark.createDataFrame([(1, "x", 1, 1, 1, "y", "one two three", None)], names)
    assert not collocations.collocations(few).count()


def test_scores_beyond_64_bits_are_exact(spark):
    n = 3_000_000_000_000_007
    row = spark.createDataFrame([(n, n + 1, n + 2)], "f long, l1 long, r1 long")
    got = row.select(collocations._score("f", "l1", "r1").alias("s")).first().s
    assert got == 10**6 * n * n // ((n + 1) * (n + 2))


def test_ranking_in_rounds(spark, rows):
    data = [(lang, f"p{i:04d}", 10 + i % 3, i % 50) for lang in ("a", "b") for i in range(2000)]
    frame = spark.createDataFrame(data, "lang string, phrase string, a long, score long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {(r.lang, r["rank"], r.phrase) for r in collocations._first_of_each(frame, 30).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = set()
    for lang in ("a", "b"):
        order = sorted((-s, -a, p) for x, p, a, s in data if x == lang)[:30]
        want |= {(lang, k, p) for k, (_, _, p) in enumerate(order, 1)}
    assert got == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aBé .\n\t本", max_size=12), max_size=5), st.integers(0, 2))
def test_split_words(texts, skip):
    array = pa.array(["?", "x", *texts], pa.string()).slice(2)
    array = array.slice(min(skip, len(array)))
    words, codes, piece, row = split_words(array, collocations.PLACES)
    got, last = [], None
    for code, p, r in zip(codes, piece, row):
        got.append((int(r), words[int(code)].as_py(), p == last))
        last = p
    want = []
    for r, text in enumerate(array.to_pylist()):
        for part in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text)):
            for k, word in enumerate(re.findall(r"[^\x20\x09]+", part)):
                want.append((r, word, k > 0))
    assert got == want and len(set(words.to_pylist())) == len(words)
    assert np.all(np.diff(row) >= 0)
