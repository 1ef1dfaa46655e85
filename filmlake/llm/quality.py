"""Quality classifier: overlapping heuristics, their accuracies by EM, a hashed linear scorer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that the scorer is fitted on at most; votes and accuracies are taken from all rows.
FIT_ROWS = 12_000
DIMENSIONS = 1 << 14
ACCEPT = 0.5

# Frequent function words of the languages in the corpus.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it as with on was by this are be from at or an a "  # English
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine "  # German
    "le la les de des et en un une du que est pour qui dans par sur pas au "  # French
    "el los las y del que en por con para una su al lo como se es ".split()  # Spanish
)
SYMBOLS = re.compile(r"[#$%&*@^~=<>{}\[\]\\_+|]")
PLAIN_END = re.compile(r"\w[.,;:?!)\"']?$")
# Longer words are not remembered.
LONG = 40
LETTERS, DIGITS, AGAIN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")


class Forms(dict):
    """The form of each word, remembered: a function word itself in lower case, else its shape.

    In a shape every run of letters is ``a``, or ``A`` for two and more capitals, every run of digits
    is ``9``, and of other repeated characters two are left. The whole word counts, whatever its
    length; long ones are not remembered.
    """

    def __missing__(self, word: str) -> str:
        if len(self) > 200_000:
            self.clear()
        plain = word.strip(".,").lower()
        if plain in FUNCTION_WORDS and not (len(word) > 1 and word.isupper()):
            form = plain
        elif word[:-1].isalpha() and (word[-1].isalpha() or word[-1] in ".,"):
            letters = word if word[-1].isalpha() else word[:-1]
            form = _letters(letters) + word[len(letters) :]
        else:
            form = LETTERS.sub(lambda run: _letters(run[0]), word)
            form = AGAIN.sub(r"\1\1", DIGITS.sub("9", form))
        if len(word) <= LONG:
            self[word] = form
        return form


def _letters(run: str) -> str:
    return "A" if len(run) > 1 and run.isupper() else "a"


class Reading:
    """A text and what several labellers and features ask about it."""

    def __init__(self, text: str, forms: Forms):
        self.text, self.words = text, text.split()
        self.n = len(self.words)
        self.forms = list(map(forms.__getitem__, self.words))
        self.counts = Counter(self.forms)
        self.each = Counter(self.words)
        self.repeats = sum(map(str.__eq__, self.words, self.words[1:]))

    def share(self, test) -> float:
        """The share of words for whose form ``test`` holds."""
        return sum(times for form, times in self.counts.items() if test(form)) / self.n


def votes(read: Reading) -> str:
    """One character per labeller: + for good, - for bad, 0 for no opinion."""
    if not read.n:
        return "-" * len(LABELLERS)
    return "".join("-0+"[labeller(read) + 1] for labeller in LABELLERS)


def shouting(read: Reading) -> int:
    return -(read.share(lambda form: form.isupper()) > 0.5)


def symbols(read: Reading) -> int:
    return -(len(SYMBOLS.findall(read.text)) / len(read.text) > 0.06)


def stuttering(read: Reading) -> int:
    return -(read.n >= 8 and read.repeats / read.n > 0.3)


def variety(read: Reading) -> int:
    return -(read.n >= 30 and len(read.each) / min(read.n, 1000) < 0.15)


def dominance(read: Reading) -> int:
    return -(read.n >= 30 and max(read.each.values()) / read.n > 0.25)


def redundancy(read: Reading) -> int:
    if read.n < 30:
        return 0
    raw = read.text.encode()
    return -(len(zlib.compress(raw, 1)) / len(raw) < 0.15)


def exclamation(read: Reading) -> int:
    return -(read.text.count("!") / read.n > 0.5)


def lone_marks(read: Reading) -> int:
    return -(read.share(lambda form: len(form) == 1 and not form.isalnum()) > 0.2)


def repeated_lines(read: Reading) -> int:
    lines = [x for x in read.text.split("\n") if x.strip()]
    return -(len(lines) >= 4 and 1 - len(set(lines)) / len(lines) > 0.6)


def function_words(read: Reading) -> int:
    if read.n < 20:
        return 0
    share = read.share(FUNCTION_WORDS.__contains__)
    return -1 if share < 0.04 else 1 if share > 0.08 else 0


def word_ends(read: Reading) -> int:
    share = read.share(lambda form: PLAIN_END.search(form) is not None)
    return -1 if share < 0.6 else 1 if share > 0.85 else 0


LABELLERS = (
    shouting,
    symbols,
    stuttering,
    variety,
    dominance,
    redundancy,
    exclamation,
    lone_marks,
    repeated_lines,
    function_words,
    word_ends,
)


def fit_labellers(
    patterns: list[str], counts: np.ndarray, rounds: int = 200
) -> tuple[float, np.ndarray, np.ndarray]:
    """(prior of good, table[labeller, class, vote], posterior of good for each pattern) by EM.

    Each labeller has its own chance of each vote for good and for bad rows and votes are
    independent given the class. It starts from the number of votes for bad, since most labellers
    know one kind of bad text only and say nothing of others, and ends when the prior no longer
    moves.
    """
    votes_ = np.array([["-0+".index(v) for v in p] for p in patterns], np.int64)
    good = 0.9 / (1 + 4.0 * (votes_ == 0).sum(axis=1))
    n_labellers = votes_.shape[1]
    prior, table = 0.5, np.empty((n_labellers, 2, 3))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - good), counts * good])
        for k in range(n_labellers):
            for y in (0, 1):
                share = np.bincount(votes_[:, k], weights[y], 3) + 0.5
                table[k, y] = share / share.sum()
        before, prior = prior, float((weights[1].sum() + 1) / (counts.sum() + 2))
        odds = math.log(prior / (1 - prior)) + sum(
            np.log(table[k, 1, votes_[:, k]] / table[k, 0, votes_[:, k]])
            for k in range(n_labellers)
        )
        good = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if abs(prior - before) < 1e-9:
            break
    return prior, table, good


class Cells(dict):
    """The place of each named feature in the hashed vector, remembered."""

    def __missing__(self, name: tuple) -> int:
        place = zlib.crc32(repr(name).encode()) % DIMENSIONS
        if sum(map(len, filter(lambda part: isinstance(part, str), name))) <= 2 * LONG:
            self[name] = place
        return place


def features(read: Reading, cells: Cells) -> tuple[list[int], list[float]]:
    """(indices, values) of a unit vector: forms, pairs of forms, repeats, variety."""
    if not read.n:
        return [], []
    found: dict[int, float] = {}
    pairs = Counter(zip(read.forms, read.forms[1:]))
    variety = round(8 * len(read.each) / read.n)
    for group in (pairs, {(f,): t for f, t in read.counts.items()}, {("variety", variety): read.n, ("repeats", 0): read.repeats}):
        for name, times in group.items():
            at = cells[name]
            found[at] = found.get(at, 0.0) + times
    values = np.sqrt(np.array(list(found.values())))
    return list(found), (values / np.linalg.norm(values)).tolist()


def fit_scorer(
    rows: list[tuple[list, list]], target: np.ndarray, steps: int = 300
) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer for targets between 0 and 1."""
    owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    column = np.array([x for i, _ in rows for x in i], np.int64)
    value = np.array([x for _, v in rows for x in v], float)
    weights, speed = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for _ in range(steps):
        score = np.bincount(owner, value * weights[column], len(rows)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - target
        slope = np.append(
            np.bincount(column, value * error[owner], DIMENSIONS), error.sum()
        ) / max(len(rows), 1)
        speed = 0.9 * speed - 2.0 * (slope + 1e-5 * weights)
        weights += speed
    return weights


class QualityModel:
    """What ``fit`` learnt: labeller accuracies, the posterior of each vote pattern, the scorer."""

    def __init__(self, prior: float, table: np.ndarray, posterior: dict[str, float], weights: np.ndarray):
        self.prior, self.table, self.posterior, self.weights = prior, table, posterior, weights

    def accuracy(self) -> dict[str, float]:
        """The share of each labeller's cast votes that are right, as estimated."""
        right = self.prior * self.table[:, 1, 2] + (1 - self.prior) * self.table[:, 0, 0]
        wrong = self.prior * self.table[:, 1, 0] + (1 - self.prior) * self.table[:, 0, 2]
        names = [f.__name__ for f in LABELLERS]
        return dict(zip(names, map(float, right / (right + wrong)), strict=True))


def _mapped(docs: DataFrame, keep: tuple[str, ...], work, fields: dict[str, tuple]) -> DataFrame:
    """The columns ``keep`` and those that ``work(texts)`` makes; fields: name -> (Spark, Arrow type)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch.column("_text").to_pylist())
            arrays = [pa.array(c, t) for c, (_, t) in zip(made, fields.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), *arrays], [*keep, *fields]
            )

    schema = T.StructType(
        [docs.schema[k] for k in keep] + [T.StructField(k, t) for k, (t, _) in fields.items()]
    )
    return docs.select(*keep, "_text").mapInArrow(run, schema)


def fit(docs: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> QualityModel | None:
    """Fit to a corpus without labels; None if it has no rows.

    Every row votes; the votes are counted by pattern (at most 3 ** 11) and EM runs on the counts.
    The scorer is fitted to the posteriors of at most about ``fit_rows`` rows, drawn by a hash of
    the text.
    """
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def voted(ts: list[str]) -> list[list]:
        forms = Forms()
        return [[votes(Reading(t, forms)) for t in ts]]

    cast = _mapped(texts, (), voted, {"votes": (T.StringType(), pa.string())})
    counted = sorted(map(tuple, cast.groupBy("votes").count().collect()))
    if not counted:
        return None
    patterns, counts = [p for p, _ in counted], np.array([c for _, c in counted], float)
    prior, table, good = fit_labellers(patterns, counts)
    posterior = dict(zip(patterns, map(float, good), strict=True))

    share = min(1.0, fit_rows / counts.sum())
    drawn = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)

    def described(ts: list[str]) -> list[list]:
        forms, cells = Forms(), Cells()
        read = [Reading(t, forms) for t in ts]
        cut = [features(r, cells) for r in read]
        return [[votes(r) for r in read], [i for i, _ in cut], [v for _, v in cut]]

    sample = _mapped(
        drawn,
        (),
        described,
        {
            "votes": (T.StringType(), pa.string()),
            "at": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
            "value": (T.ArrayType(T.FloatType()), pa.list_(pa.float32())),
        },
    ).limit(2 * fit_rows).toArrow().to_pydict()  # equal texts are drawn together, hence the room
    rows = list(zip(sample["at"], sample["value"], strict=True))
    target = np.array([posterior[v] for v in sample["votes"]])
    return QualityModel(prior, table, posterior, fit_scorer(rows, target))


def keep_accepted(
    docs: DataFrame, model: QualityModel | None, text: str = "text", accept: float = ACCEPT
) -> DataFrame:
    """The rows of ``docs`` that ``score`` accepts, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, cells = Forms(), Cells()
        for batch in batches:
            texts = batch.column(text).to_pylist()
            good = [_point(Reading(t or "", forms), model, cells) >= accept for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _point(read: Reading, model: QualityModel | None, cells: Cells) -> float:
    at, value = features(read, cells)
    if not at or model is None:
        return 1.0 if at else 0.0
    z = float(model.weights[at] @ np.array(value) + model.weights[-1])
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def score(
    docs: DataFrame,
    model: QualityModel | None,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    accept: float = ACCEPT,
) -> DataFrame:
    """The columns ``keep``, votes, posterior, score and accepted of every row.

    ``score`` (0 to 1, higher: better) is the scorer's, ``posterior`` that of the row's votes, 0.5
    for a pattern the model has not seen. A text without words, null included, scores 0 and is not
    accepted. Without a model every row with words is accepted.
    """
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def judged(ts: list[str]) -> list[list]:
        forms, cells = Forms(), Cells()
        cast, points = [], []
        for text in ts:
            read = Reading(text, forms)
            cast.append(votes(read))
            points.append(_point(read, model, cells))
        known = model.posterior if model else {}
        return [cast, [known.get(v, 0.5) for v in cast], points, [p >= accept for p in points]]

    return _mapped(
        rows,
        keep,
        judged,
        {
            "votes": (T.StringType(), pa.string()),
            "posterior": (T.DoubleType(), pa.float64()),
            "score": (T.DoubleType(), pa.float64()),
            "accepted": (T.BooleanType(), pa.bool_()),
        },
    )
