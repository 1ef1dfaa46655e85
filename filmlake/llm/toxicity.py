"""Toxicity: boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmlake.session import materialize

# Labelled rows that a model is fitted on at most, and entries of each lexicon.
FIT_ROWS = 20_000
LEXICON = 2_000
PREFIXES = range(4, 9)
THRESHOLD = 0.7

# Words of the second person, by language, and characters that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur "  # English
    "du dich dir dein deine ihr euch euer "  # German
    "tu te toi ton ta tes vous votre vos "  # French
    "tú ti tus usted ustedes vosotros ".split()  # Spanish
)
LETTER_OF = str.maketrans("013457@$!|+", "oieastasilt")
MARKS = re.compile(r"[^\w@$!|+*]|_")
EDGES = re.compile(r"^\W+|\W+$")
BETWEEN = re.compile(r"[\W_]+")  # what the words of a lexicon are split at
STRETCHED = re.compile(r"(.)\1{2,}")

FEATURES = (
    "words",
    "lexicon_density",
    "prefix_density",
    "hits",
    "thickest",
    "near_second_person",
    "second_person",
    "capitals",
    "exclamations",
    "questions",
    "punctuation",
    "obfuscation",
    "obfuscated_hits",
    "stretching",
)


@dataclass(frozen=True)
class Lexicon:
    """Words, and beginnings of words, that mark toxic texts."""

    words: frozenset[str]
    prefixes: frozenset[str]

    def begins(self, word: str) -> bool:
        return any(word[:k] in self.prefixes for k in PREFIXES)


# What is remembered of a word, as bits.
WORD, START, HIDDEN, PERSON, CAPITAL, MIXED, LONG = (1 << k for k in range(7))


class _Marks(dict):
    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, raw: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bare = EDGES.sub("", raw)
        word = bare.lower()
        parts = [word] if word.isalnum() else [word, *BETWEEN.split(word)]
        mark = 0
        if not self.lexicon.words.isdisjoint(parts):
            mark |= WORD
        if any(map(self.lexicon.begins, parts)):
            mark |= START
        if not SECOND_PERSON.isdisjoint(parts):
            mark |= PERSON
        if len(bare) > 1 and bare.isupper():
            mark |= CAPITAL
        if not word.isalpha() and any(c.isalpha() for c in word):
            mark |= MIXED
            plain = MARKS.sub("", word.translate(LETTER_OF)).replace("*", "")
            if plain != word and (plain in self.lexicon.words or self.lexicon.begins(plain)):
                mark |= HIDDEN
        if STRETCHED.search(word):
            mark |= LONG
            if STRETCHED.sub(r"\1", word) in self.lexicon.words:
                mark |= HIDDEN
        self[raw] = mark
        return mark


def features(text: str, marks: dict[str, int]) -> list[float]:
    """The dense features of a text, in the order of FEATURES; zeros without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    seen = np.fromiter(map(marks.__getitem__, words), np.int64, n)
    share = lambda bits: float(np.count_nonzero(seen & bits)) / n
    hits = np.flatnonzero(seen & (WORD | START | HIDDEN))
    people = np.flatnonzero(seen & PERSON)
    near, thickest = 0.0, 0
    if len(hits):
        window = np.searchsorted(hits, hits + 50) - np.arange(len(hits))
        thickest = int(window.max())
        if len(people):
            at = np.searchsorted(people, hits)
            after = np.abs(people[np.minimum(at, len(people) - 1)] - hits)
            before = np.abs(people[np.maximum(at - 1, 0)] - hits)
            near = float(np.mean(1.0 / (1.0 + np.minimum(after, before))))
    size = len(text)
    return [
        float(np.log1p(n)),
        share(WORD),
        share(START),
        float(np.log1p(len(hits))),
        float(np.log1p(thickest)),
        near,
        share(PERSON),
        share(CAPITAL),
        text.count("!") / size,
        text.count("?") / size,
        (text.count(".") + text.count(",") + text.count("*") + text.count("#")) / size,
        share(MIXED),
        share(HIDDEN),
        share(LONG),
    ]


def described(docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``features`` (array of double) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = _Marks(lexicon)
        for batch in batches:
            rows = [features(t or "", marks) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(rows, pa.list_(pa.float64()))],
                [*keep, "features"],
            )

    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType(
        [rows.schema[k] for k in keep] + [T.StructField("features", T.ArrayType(T.DoubleType()))]
    )
    return rows.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """The row's fold, 0 to 2: the CRC-32 of its identifier as text, modulo 3; null for no identifier."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> Lexicon:
    """The words and word beginnings of ``rows`` (text, label) that toxic texts hold far more often.

    An entry is in at least 4 toxic texts and, with half a text added to each side, its share of the
    toxic texts is over 20 times that of the others; of each sort the ``size`` with the
    highest ratio are taken, ties by the entry. Texts are counted once for each entry.
    """
    totals = rows.agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = (totals["t"] or 0) + 1, totals["n"] - (totals["t"] or 0) + 1
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"))
    entries = {
        "words": words,
        "prefixes": F.array_distinct(
            F.flatten(
                F.transform(
                    words,
                    lambda w: F.filter(
                        F.array(*(F.substr(w, F.lit(1), F.lit(k)) for k in PREFIXES)),
                        lambda p, at: F.length(p) == at + PREFIXES[0],
                    ),
                )
            )
        ),
    }
    found = {}
    for sort, of in entries.items():
        ratio = ((F.col("t") + 0.5) / toxic) / ((F.col("n") - F.col("t") + 0.5) / clean)
        top = (
            rows.select("label", F.explode(of).alias("entry"))
            .filter("entry <> ''")
            .groupBy("entry")
            .agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
            .filter("t >= 4")
            .withColumn("ratio", ratio)
            .filter("ratio > 20")
            .orderBy(F.desc("ratio"), "entry")
            .limit(size)
        )
        found[sort] = frozenset(r["entry"] for r in top.collect())
    return Lexicon(**found)


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, trees and calibration; without trees every text scores ``rate``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Fit to the rows whose identifier has a label and whose fold is not 1.

    ``labels`` has one 0 or 1 per identifier; the larger of repeated ones counts, null ones and
    null identifiers none. At most about ``fit_rows`` labelled identifiers are drawn by a hash of
    the identifier: half of them make the lexicon, the others the trees (six tenths) and the
    calibration, so that no step is fitted to what the one before it has seen. Labels of one kind
    only, or none, give a model that scores their rate (0 without labels).
    """
    usable = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
        .filter((fold(F.col("doc_id")) != 1) & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    ticket = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
    total = usable.count()
    drawn = usable.filter(ticket < max(1, int(1_000_000 * min(1.0, fit_rows / max(total, 1)))))
    rows = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        # At most about fit_rows rows of two numbers.
        .join(F.broadcast(drawn), "doc_id")
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))),
        "labelled",
    )
    lexicon = learn_lexicon(rows.filter("part < 5"))
    known = materialize(
        described(rows.filter("part >= 5"), lexicon, ("label", "part"))
        .withColumn("vector", array_to_vector("features"))
        .repartition(4),
        "described",
    )
    kinds = {(r["part"] < 8, r["label"]) for r in known.select("part", "label").distinct().collect()}
    if len(kinds) < 4:
        rate = rows.agg(F.avg("label")).first()[0]
        return ToxicityModel(lexicon, None, None, float(rate or 0.0))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxDepth=3, maxIter=20, stepSize=0.2, seed=7
    ).fit(known.filter("part < 8"))
    raw = _raw(trees.transform(known.filter("part >= 8")))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return ToxicityModel(lexicon, trees, calibration, 0.0)


def _raw(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("raw", vector_to_array("probability")[1]).drop("prediction")


def score(
    docs: DataFrame,
    model: ToxicityModel,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic), predicted (1 from ``threshold``).

    One row per row. The score is the calibrated one, with a thousandth of the trees' own so that
    texts of one calibrated step keep their order. Null and empty texts are scored by their
    features, which are all zero. A row without an identifier is not held out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model.trees is None:
        scored = rows.select("doc_id", F.lit(model.rate).alias("score"))
    else:
        vectors = described(rows, model.lexicon, ("doc_id",)).select(
            "doc_id", array_to_vector("features").alias("vector")
        )
        scored = model.calibration.transform(_raw(model.trees.transform(vectors)).select("doc_id", "raw"))
        scored = scored.select("doc_id", (0.999 * F.col("prediction") + 0.001 * F.col("raw")).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
