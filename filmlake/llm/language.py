"""Language identification by a linear-chain conditional random field over words.

Every word has features (its beginnings and ends, its character n-grams, how a lexicon shares it out
among the languages), and neighbouring words have learned transitions, so that text which switches
its language within is labelled word by word. A document's language is the one with the largest
mean probability over its words, by forward-backward over the whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from filmlake.session import broadcast_checked, materialize

from .common import as_scan, locator, slices, text_of
from .words import GAP, LOWER, WORD, split_words

# The field is fitted to one passage of so many words of so many distinct texts of each language.
FIT_TEXTS, PASSAGE = 300, 100
DIMENSIONS = 1 << 16
STEPS, RATE, DECAY = 60, 0.1, 1e-4
# Languages' shares of a word in the lexicon are told apart at these borders.
SHARES = (0.02, 0.2, 0.5, 0.8, 0.98)
UNKNOWN = "und"
# Scores of so many words are remembered by a task; longer words are not.
REMEMBERED, LONG = 400_000, 40
# A label whose score is so far below the best of a word counts as this far.
FARTHEST = 60.0

LETTERS = np.full(256, GAP, np.uint8)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = WORD
assert (LOWER[65:91] == np.arange(97, 123)).all()


class Field(NamedTuple):
    """Languages, weights of hashed features, transitions, beginnings, and the lexicon's features."""

    languages: list[str]
    weights: np.ndarray
    steps: np.ndarray
    starts: np.ndarray
    lexicon: dict[str, tuple[int, ...]]


def letters_of(word: str) -> str:
    """The letters of a word in lower case; runs of other characters than ASCII hold marks too."""
    return word if word.isascii() else "".join(filter(str.isalpha, word)).lower()


def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % DIMENSIONS


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """The numbers of a word's features: affixes, n-grams of 2 and 3 characters, lexicon."""
    edged = f"^{word}$"
    names = [f"a{word[:k]}" for k in (1, 2, 3)] + [f"z{word[-k:]}" for k in (1, 2, 3)]
    names += [f"n{edged[i : i + 2]}" for i in range(len(edged) - 1)]
    names += [f"n{edged[i : i + 3]}" for i in range(len(edged) - 2)]
    return [*map(_number, names), *lexicon.get(word, (_number("lexicon: none"),))]


def make_lexicon(passages: list[tuple[int, list[str]]], languages: int) -> dict[str, tuple[int, ...]]:
    """For each word of labelled passages one feature for each language: its share of the word."""
    counts: dict[str, Counter] = defaultdict(Counter)
    totals: Counter = Counter()
    for label, words in passages:
        totals[label] += len(words)
        for word in words:
            counts[word][label] += 1
    found = {}
    for word, of in counts.items():
        rates = np.array([of[k] / max(totals[k], 1) for k in range(languages)])
        levels = np.searchsorted(SHARES, rates / rates.sum())
        found[word] = tuple(_number(f"lexicon: {k} {level}") for k, level in enumerate(levels))
    return found


def _scores(words: list[str], weights: np.ndarray, lexicon: dict) -> np.ndarray:
    """A line of label scores for each word."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    numbers = [features(word, lexicon) for word in words]
    ends = np.cumsum([0, *map(len, numbers)])
    return np.add.reduceat(weights[np.concatenate(numbers)], ends[:-1], axis=0)


def forward_backward(
    scores: np.ndarray, first: np.ndarray, steps: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(emission, forward, backward) of every place of a row of sequences, each line up to a factor.

    ``first`` marks where a sequence begins. A place is a matrix from the label before to its own; at
    a beginning all lines of the matrix are equal, which forgets what came before. The row is cut into
    about as many blocks as a block has places; the products of all blocks are formed side by side,
    chained, and each block is then walked from what reaches it. So long sequences take no longer.
    """
    n, k = scores.shape
    size = max(1, int(np.ceil(np.sqrt(n))))
    blocks = -(-n // size)
    emission = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -FARTHEST))
    e = np.ones((blocks * size, k))
    e[:n] = emission
    begins = np.ones(blocks * size, bool)
    begins[:n] = first
    e, begins = e.reshape(blocks, size, k), begins.reshape(blocks, size)
    go, begin = np.exp(steps), np.exp(starts)

    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(size):
        at = np.where(begins[:, t, None, None], begin, go) * e[:, t, None, :]
        product = product @ at
        product = product / product.max(axis=(1, 2), keepdims=True)
    into, out = np.ones((blocks, k)), np.ones((blocks, k))
    for b in range(1, blocks):
        into[b] = into[b - 1] @ product[b - 1]
        into[b] /= into[b].sum()
    for b in range(blocks - 1, 0, -1):
        out[b - 1] = product[b] @ out[b]
        out[b - 1] /= out[b - 1].sum()

    forward, backward = np.empty_like(e), np.empty_like(e)
    for t in range(size):
        into = np.where(begins[:, t, None], begin, into @ go) * e[:, t]
        into /= into.sum(axis=1, keepdims=True)
        forward[:, t] = into
    for t in range(size - 1, -1, -1):
        backward[:, t] = out
        out = np.where(begins[:, t, None], 1.0, (out * e[:, t]) @ go.T)
        out /= out.sum(axis=1, keepdims=True)
    return emission, forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]


def probabilities(scores: np.ndarray, first: np.ndarray, steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The probability of each label at each place, given its whole sequence."""
    if not len(scores):
        return np.zeros(scores.shape)
    _, forward, backward = forward_backward(scores, first, steps, starts)
    found = forward * backward
    return found / found.sum(axis=1, keepdims=True)


def _sequences(passages: list[tuple[int, list[str]]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(words, labels, first) of training sequences: pieces of passages, languages switching within.

    Every passage is cut at random; the pieces follow each other in random order, and half of the
    time a piece continues the sequence before it.
    """
    draw = np.random.default_rng(5)
    pieces = []
    for label, words in passages:
        at = 0
        while at < len(words):
            size = int(draw.integers(1, 41))
            pieces.append((label, words[at : at + size]))
            at += size
    order = draw.permutation(len(pieces))
    words, labels, first = [], [], []
    for i in order:
        label, piece = pieces[i]
        first += [not words or bool(draw.random() < 0.5)] + [False] * (len(piece) - 1)
        words += piece
        labels += [label] * len(piece)
    return words, np.array(labels, int), np.array(first, bool)


def train(passages: list[tuple[str, list[str]]], steps: int = STEPS) -> Field:
    """The field fitted to labelled passages, by ascent on the likelihood of all sequences together.

    Every other passage of a language goes into the lexicon, so that the weights of lexicon features
    are learnt on words that the lexicon was not made from. One language is its own answer.
    """
    languages = sorted({language for language, _ in passages})
    k = len(languages)
    halves: tuple[list, list] = [], []
    seen: Counter = Counter()
    for language, words in passages:
        halves[seen[language] % 2].append((languages.index(language), words))
        seen[language] += 1
    lexicon = make_lexicon(halves[1], k)
    words, labels, first = _sequences(halves[0])
    weights, moves, starts = np.zeros((DIMENSIONS, k)), np.zeros((k, k)), np.zeros(k)
    if k < 2 or not words:
        return Field(languages, weights.astype(np.float32), moves, starts, lexicon)
    distinct, codes = np.unique(np.array(words, object), return_inverse=True)
    numbers = [features(word, lexicon) for word in distinct]
    sizes = np.array([*map(len, numbers)])
    flat, ends = np.concatenate(numbers), np.cumsum([0, *sizes])
    truth = np.eye(k)[labels]
    inner = np.flatnonzero(~first)
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (labels[inner - 1], labels[inner]), 1)
    parts = [weights, moves, starts]
    pace = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for step in range(1, steps + 1):
        scores = np.add.reduceat(weights[flat], ends[:-1], axis=0)[codes]
        emission, forward, backward = forward_backward(scores, first, moves, starts)
        chance = forward * backward
        chance /= chance.sum(axis=1, keepdims=True)
        missing = truth - chance
        by_word = np.stack([np.bincount(codes, missing[:, c], len(distinct)) for c in range(k)], axis=1)
        spread = np.repeat(by_word, sizes, axis=0)
        up = np.stack([np.bincount(flat, spread[:, c], DIMENSIONS) for c in range(k)], axis=1)
        before, after = forward[inner - 1], (emission * backward)[inner]
        each = ((before @ np.exp(moves)) * after).sum(axis=1, keepdims=True)
        expected = (before / each).T @ after * np.exp(moves)
        slopes = [up, seen_moves - expected, missing[first].sum(axis=0)]
        for part, slope, (mean, square) in zip(parts, slopes, pace):
            slope = slope / len(words) - DECAY * part / 100
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            part += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(languages, weights.astype(np.float32), moves, starts, lexicon)


def fold(doc_id: str = "doc_id") -> Column:
    """The fold of a row, 0 to 2: crc32 of its identifier as text, modulo 3; null without one."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    fit_texts: int = FIT_TEXTS, passage: int = PASSAGE,
) -> Field:
    """The field learnt from rows with a text and a lang whose fold is not 1.

    The bounded sample: of each language ``fit_texts`` distinct texts, the first by a hash, and of
    each a passage of ``passage`` words at a place that the hash decides.
    """
    docs = as_scan(docs)
    known = docs.filter((fold(doc_id) != 1) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    mark = F.xxhash64(text)
    texts = known.groupBy(F.col(lang).alias("language"), mark.alias("mark")).agg(F.min(locator()).alias("place"))
    first = W.partitionBy("language").orderBy("mark")
    chosen = texts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= fit_texts)
    chosen = materialize(chosen.select("language", "mark", "rank", "place"), "fit-texts")
    rows = docs.select(locator().alias("place"), F.col(text).alias("text"))
    rows = rows.join(broadcast_checked(chosen), "place").select("language", "mark", "rank", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, codes, _, _ = split_words(pa.array([row["text"]], pa.string()), LETTERS)
                begin = row["mark"] % max(1, len(codes) - passage + 1)
                found = [letters_of(w) for w in words.take(codes[begin : begin + passage]).to_pylist()]
                row["words"] = [word for word in found if word]
                yield pa.RecordBatch.from_pylist(
                    [{c: row[c] for c in ("language", "rank", "words")}],
                    pa.schema([("language", pa.string()), ("rank", pa.int32()), ("words", pa.list_(pa.string()))]),
                )

    passages = rows.mapInArrow(cut, "language string, rank int, words array<string>").collect()
    return train([(p.language, p.words) for p in sorted(passages, key=lambda p: (p.rank, p.language)) if p.words])


class _Scorer:
    """Label scores of distinct words, remembered from one batch to the next."""

    def __init__(self, field: Field):
        self.field, self.known = field, {}
        # line 0 is for words without a letter
        self.table = np.zeros((1, len(field.languages)), np.float32)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, whether it has a letter) of each word."""
        if len(self.table) > REMEMBERED:
            self.__init__(self.field)
        new = [word for word in words if word not in self.known]
        plain = [letters_of(word) for word in new]
        scores = _scores([word for word in plain if word], self.field.weights, self.field.lexicon)
        table = np.concatenate([self.table, scores.astype(np.float32)])
        places, free = {}, len(self.table)
        for word, letters in zip(new, plain):
            places[word] = free if letters else 0
            free += bool(letters)
        at = np.array([places[word] if word in places else self.known[word] for word in words], int)
        self.table = table
        self.known.update({word: place for word, place in places.items() if len(word) <= LONG})
        return table[at], at > 0


def _read(batches: Iterator[pa.RecordBatch], field: Field):
    """(rows of a batch, row of each word, probabilities of each word) of slices of batches."""
    scorer = _Scorer(field)
    for batch in batches:
        for part in slices(batch, "_text"):
            words, codes, _, row = split_words(part.column("_text"), LETTERS)
            scores, lettered = scorer(words.to_pylist())
            here = lettered[codes] if len(codes) else np.zeros(0, bool)
            codes, row = codes[here], row[here]
            first = np.diff(row, prepend=-1) != 0
            yield part, row, probabilities(scores[codes].astype(float), first, field.steps, field.starts)


def predict(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep``, lang_pred and score (0 to 1) of every row.

    The score is the language's mean probability over the words of the whole text; ties go to the
    language that sorts first. A text that is null or has no letter is ``und`` with score 0, and so is
    all text if no language was learnt.
    """
    rows = docs.select(*keep, text_of(text).alias("_text"))
    # bounded: DIMENSIONS numbers for each language, and the words of the sample
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        names = np.array([*field.languages, UNKNOWN], object)
        for part, row, chance in _read(batches, field) if field.languages else _nothing(batches):
            n, k = part.num_rows, len(field.languages)
            words = np.bincount(row, minlength=n)
            sums = np.stack([np.bincount(row, chance[:, c], n) for c in range(k)], axis=1) if k else np.zeros((n, 1))
            best = sums.argmax(axis=1)
            score = np.minimum(sums[np.arange(n), best] / np.maximum(words, 1), 1.0)
            named = names[np.where(words > 0, best, len(names) - 1)]
            yield pa.RecordBatch.from_arrays(
                [*part.select(list(keep)).columns, pa.array(named, pa.string()), pa.array(score)],
                [*keep, "lang_pred", "score"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"]
    return rows.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def _nothing(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield batch, np.zeros(0, int), np.zeros((0, 0))


def spans(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` and spans, (language, words) in order: where the text switches languages.

    Words are runs of letters; neighbours whose most probable language is the same are one span.
    """
    rows = docs.select(*keep, text_of(text).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for part, row, chance in _read(batches, field) if field.languages else _nothing(batches):
            label = chance.argmax(axis=1) if len(chance) else np.zeros(0, int)
            begins = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
            sizes = np.diff(begins, append=len(row))
            ends = np.searchsorted(row[begins], np.arange(part.num_rows + 1))
            items = pa.StructArray.from_arrays(
                [pa.array([field.languages[c] for c in label[begins]], pa.string()), pa.array(sizes, pa.int64())],
                ["language", "words"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
            yield pa.RecordBatch.from_arrays([*part.select(list(keep)).columns, lists], [*keep, "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"]
    return rows.mapInArrow(run, ", ".join([*fields, "spans array<struct<language: string, words: long>>"]))
