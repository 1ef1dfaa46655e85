import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from filmlake.llm import suffixes

LENGTH, K = 40, 12


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[s : s + length] for r in raws for s in range(len(r) - length + 1))
    found = []
    for r in raws:
        cover = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                cover[s : s + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]])))
        kept = bytes(b for b, c in zip(r, cover, strict=True) if not c)
        found.append(
            (len(r), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)),
             hashlib.sha256(kept).hexdigest())
        )
    return found


def corpus():
    draw = random.Random(8)
    noise = lambda n: "".join(draw.choice("abcdé日 \n") for _ in range(n))
    shared, exact, short = noise(90), "s" * LENGTH, noise(20)
    texts = [None, "", "x", noise(300), "ab" * 100, "q" * 500, noise(30) + exact, exact + noise(11)]
    for _ in range(25):
        texts.append(noise(draw.randrange(60)) + shared + noise(draw.randrange(60)))
        texts.append(noise(50) + short + noise(50))
    texts += [texts[3], texts[-1], texts[-1], noise(20) + texts[9][10:70], "ab" * 30 + noise(9)]
    return texts


@pytest.mark.parametrize(("batches", "most"), [(1, 20_000), (4, 20_000), (5, 1)])
def test_against_brute_force(spark, batches, most):
    texts = corpus()
    docs = spark.createDataFrame(
        [(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, node int"
    ).repartition(3)
    got = suffixes.repeated_spans(docs, length=LENGTH, k=K, batches=batches, most_together=most)
    rows = {r.doc_id: r for r in got.collect()}
    for k, (size, spans, kept) in enumerate(brute(texts, LENGTH)):
        r = rows[k]
        assert (r.n_bytes, [(s.begin, s.end) for s in r.spans], r.kept_sha256) == (size, spans, kept)
        assert r.n_removed == sum(b - a for a, b in spans)


def test_repeated_rows_and_null_identifiers(spark):
    text = "z" * 30 + "y" * 30
    docs = spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id long, text string")
    got = suffixes.repeated_spans(docs, length=LENGTH, k=K).collect()
    assert [(r.n_removed, len(r.spans)) for r in got] == [(60, 1)] * 3


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.repeated_spans(docs, length=LENGTH, k=K).count() == 0


def test_long_texts_are_cut_into_segments(monkeypatch):
    raw = corpus()[3].encode() * 3
    whole = suffixes.anchors(raw, LENGTH, K)
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    parts = suffixes.anchors(raw, LENGTH, K)
    strings = lambda a: {
        (p - x, p) for _, p, low, high in zip(*a, strict=True) for x in range(low, high + 1)
    }
    assert strings(whole) == strings(parts)
    assert len({s for s, _ in strings(whole)}) == len(raw) - LENGTH + 1


def test_levels_double(spark):
    family = suffixes.SuffixFamily(spark)
    rows = [(k % 7, k) for k in range(40)]
    found = set()
    for number in range(5):
        batch = spark.createDataFrame([r for r in rows if r[1] % 5 == number], "key long, node long")
        found |= {r.key for r in family.add(batch).collect()}
    assert [size for size, _ in family.levels] == [4, 1]
    assert found == set(range(7)) and family.suffixes().count() == 40
