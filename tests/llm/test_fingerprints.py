import hashlib
import random

import numpy as np
import pytest

from filmlake.llm import fingerprints as fp
from filmlake.llm.shingles import shingle_sets


def words(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_estimates_come_near_the_truth():
    base = words(6000, 1)
    part = " ".join(base.split()[:3000])
    a, b = shingle_sets([base, part])
    pa_, pb = fp.fingerprint(a), fp.fingerprint(b)
    both = len(np.intersect1d(a, b))
    assert abs(fp.likeness(pa_, pb) - both / len(np.union1d(a, b))) < 0.06
    assert abs(fp.containment(pb, pa_) - 1) < 0.02 and abs(fp.containment(pa_, pb) - 0.5) < 0.06
    assert fp.likeness(pa_, fp.fingerprint(shingle_sets([words(6000, 2)])[0])) < 0.01


def test_merged_sketches_are_those_of_the_union():
    a, b = shingle_sets([words(900, 1), words(30, 2)])
    union = fp.fingerprint(np.union1d(a, b))
    merged = fp.merged(fp.fingerprint(a), fp.fingerprint(b))
    assert fp.kept_hashes(merged).tolist() == fp.kept_hashes(union).tolist()
    assert fp.merged(union, union) == union


def test_every_text_keeps_the_same_share():
    for n in (0, 6, 20, 200, 300, 1000, 5000):
        (shingles,) = shingle_sets([words(n, n)])
        print_ = fp.fingerprint(shingles)
        below = [int(h) >> 16 for h in shingles if int(h) < 2**64 // fp.SCALE]
        assert fp.share_of(print_) == fp.SCALE
        assert fp.kept_hashes(print_).tolist() == sorted(below)


@pytest.mark.parametrize("n,mean", [(20, 0.16), (100, 0.08), (400, 0.04), (2000, 0.02)])
def test_the_error_falls_with_the_length(n, mean):
    wrong = []
    for seed in range(60):
        text, after = words(n, seed), words(n, 1000 + seed)
        a, b = shingle_sets([text, fp.edited(text, after)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        wrong.append(abs(fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) - true))
    assert np.mean(wrong) < mean


def test_a_short_text_within_a_long_one():
    long = words(20_000, 1).split()
    parts = [" ".join(long[k : k + 300]) for k in range(0, 18_000, 900)]
    whole, *rest = [fp.fingerprint(s) for s in shingle_sets([" ".join(long), *parts])]
    assert all(fp.containment(p, whole) == 1.0 for p in rest)
    half = [p + " " + words(300, 7 + k) for k, p in enumerate(parts)]
    got = [fp.containment(fp.fingerprint(s), whole) for s in shingle_sets(half)]
    assert all(abs(g - 0.5) < 0.12 for g in got) and abs(np.mean(got) - 0.5) < 0.03


@pytest.mark.parametrize("left,right", [(20, 200), (200, 200), (250, 700), (20, 3000), (900, 1100), (3000, 5000)])
@pytest.mark.parametrize("scales", [(2, 2), (1, 4)])
def test_merging_keeps_the_hashes_of_the_union(left, right, scales):
    a, b = shingle_sets([words(left, 1), words(right, 2)])
    union = fp.fingerprint(np.union1d(a, b), max(scales))
    merged = fp.merged(fp.fingerprint(a, scales[0]), fp.fingerprint(b, scales[1]))
    assert fp.share_of(merged) == max(scales)
    assert fp.kept_hashes(merged).tolist() == fp.kept_hashes(union).tolist()


ROWS = [
    (10, "the quick brown fox jumps over the lazy dog again"),
    (None, None),
    (3, ""),
    (7, "the quick brown fox jumps over the lazy dog again"),
    (7, "the quick brown fox jumps over the lazy dog again"),
    (8, words(400, 4)),
    (-2, "äöü 日本 word"),
    (5, words(20_000, 5)),
]


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("partitions", ["1", "3", "8"])
@pytest.mark.parametrize("range_rows", [2, 10_000])
def test_every_row_against_its_edited_text(spark, monkeypatch, partitions, kind, range_rows):
    monkeypatch.setattr(fp, "RANGE_ROWS", range_rows)
    named = {None: None, 7: "doc-é", 10: "", 8: "doc-b", -2: "doc", 3: "Zebra", 5: "doc-éa"}
    rows = [(named[i] if kind == "string" else i, t) for i, t in ROWS]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = spark.createDataFrame([(i, t, "c") for i, t in rows], f"doc_id {kind}, text string, guest string")
        got = fp.compare_edited(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: r[1] or "")
    bytes_of = lambda i: i.encode() if isinstance(i, str) else i
    order = sorted(order, key=lambda r: (r[0] is not None, bytes_of(r[0]) if r[0] is not None else 0), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        changed = fp.edited(t, after)
        cut = len(t) // 3
        assert changed == t[: len(t) - cut] + after[:cut]
        prints = [fp.fingerprint(s) for s in shingle_sets([t, changed, after])]
        want.append(
            (i, len(t), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
             fp.likeness(prints[0], prints[1]), fp.likeness(prints[0], prints[2]))
        )
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)


def test_an_empty_table_and_a_single_row(spark):
    assert fp.compare_edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = fp.compare_edited(spark.createDataFrame([(1, "abc")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 3
