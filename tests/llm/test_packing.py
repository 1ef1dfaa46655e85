import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filmlake.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_tokenizers_own(text):
    coder = tokenizer()
    got = packing.token_bytes([text], coder, packing._WordIds(coder))[0]
    assert np.frombuffer(got, "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


def test_ids_of_chosen_texts():
    coder = tokenizer()
    words = packing._WordIds(coder)
    for text in ["", "It's  A\ttest, isn't it?", "Straße ÀÉ µ²¾ ß", "'s''re!'ll", "\x1c\x85\xa0a", "İstanbul", "日本語 😀", "<|endoftext|> x", "é"]:
        got = packing.token_bytes([text], coder, words)[0]
        assert np.frombuffer(got, "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


def test_pieces_and_places(spark):
    texts = [None, "", "one two", "word " * 60, "a b c d e f g " * 7, "one two"]
    docs = spark.createDataFrame(
        [(k if k else None, t, 9) for k, t in enumerate(texts)], "doc_id long, text string, length int"
    )
    pieces = packing.token_pieces(docs, PATH, limit=16)
    coder = tokenizer()
    want = {}
    for k, t in enumerate(texts):
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 16)):
            want[(k, piece)] = (at, ids[at : at + 16])
    got = {(r.doc_id or 0, r.piece): (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in pieces.collect()}
    assert got == want
    placed = packing.pack(pieces.drop("ids"), limit=16, group_pieces=4).collect()
    assert len(placed) == len(want)
    check_places(placed, 16)


def check_places(rows, limit):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_sum_of_squares_fills_sequences():
    lengths = np.random.default_rng(1).integers(1, 900, 20_000)
    bins, _ = packing.sum_of_squares(lengths, 1000)
    least = -(-int(lengths.sum()) // 1000)
    assert bins.max() + 1 <= least * 1.01 + 1
    assert np.bincount(bins, lengths).max() <= 1000


def test_the_rule_itself():
    lengths = np.array([6, 6, 4, 3, 3, 2])
    bins, offsets = packing.sum_of_squares(lengths, 10)
    open_bins, fill = [], []
    for item in np.argsort(-lengths, kind="stable"):
        best = None
        for gap in sorted({10 - f for f in fill if 10 - f >= lengths[item]} | {10}):
            after = sorted(fill)
            if gap < 10:
                after.remove(10 - gap)
            after.append(10 - gap + lengths[item])
            gaps = [10 - f for f in after if f < 10]
            cost = sum(gaps.count(g) ** 2 for g in set(gaps))
            if best is None or cost < best[0]:
                best = (cost, gap)
        if best[1] < 10:
            fill.remove(10 - best[1])
        fill.append(10 - best[1] + lengths[item])
        open_bins.append(best[1])
    assert sorted(np.bincount(bins, lengths).astype(int)) == sorted(map(int, fill))


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    pieces = packing.token_pieces(docs, PATH)
    assert packing.pack(pieces).count() == 0


def test_query(spark):
    rows = queries.best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    sequences = check_places(rows, 4096)
    assert sequences <= -(-sum(r.length for r in rows) // 4096) * 1.03 + 1
    one = next(r for r in rows if r.piece == 0 and r.length < 4096)
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(f"doc_id = {one.doc_id}").first().text
    ids = [*tokenizer().encode(text, add_special_tokens=False).ids, 1]
    assert zlib.crc32(np.array(ids, "<u4").tobytes()) == one.ids_crc32
