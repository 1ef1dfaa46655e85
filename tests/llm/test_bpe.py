import base64
import random

import public_tokenizers
import tiktoken

from filmlake.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def whole():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(3)
    words = ["the", "don't", "l'été", "日本語", "x" * 30, "12", "...", "😀", "We'll", "\t", "\n\n", " "]
    mixed = ["".join(draw.choice(words) + draw.choice(["", " ", "  "]) for _ in range(200)) for _ in range(12)]
    runs = [" " * 900, "a" * 900, "a " * 400 + "b" * 700 + " c" * 300, "日本" * 500, "'s" * 300]
    return [None, "", "a", "<|endoftext|>", *mixed, *runs, mixed[0]]


def test_any_chunking_gives_the_ids_of_the_whole_text(spark):
    docs = spark.createDataFrame(
        [(k if k else None, t, "x") for k, t in enumerate(texts())], "doc_id long, text string, ids string"
    )
    coder = whole()
    for chunk, overlap in ((64, 16), (200, 50), (100_000, 100)):
        coded = bpe.encode(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap)
        got = sorted((r.doc_id or 0, r.ids) for r in coded.collect())
        assert got == [(k, coder.encode_ordinary(t or "")) for k, t in enumerate(texts())]
        plain = bpe.decode(coded, RANKS, PATTERN).collect()
        assert sorted((r.doc_id or 0, bytes(r.bytes)) for r in plain) == [
            (k, (t or "").encode()) for k, t in enumerate(texts())
        ]


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    coded = bpe.encode(docs, RANKS, PATTERN)
    assert coded.columns == ["doc_id", "ids"] and coded.count() == 0
    assert bpe.decode(coded, RANKS, PATTERN).count() == 0


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.bytes for r in bpe.decode(rows, RANKS, PATTERN).collect()}
    assert got[1] is None and bytes(got[2]) == b""


def test_certain_boundaries_hold_from_any_start():
    body = "don't  stop12 now, l'été... 日本 語!!\n\n x"
    true = {0}
    for match in __import__("regex").finditer(PATTERN, body):
        true.add(match.end())
    for begin in range(len(body)):
        for at in bpe.certain_boundaries(body[begin:], PATTERN, 0, len(body)):
            assert begin + at in true
