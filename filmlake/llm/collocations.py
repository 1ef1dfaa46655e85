"""Phrase collocations by relational mining: sorted occurrence relations, merged and counted.

An occurrence relation of length k lists where each phrase of k words begins. It is kept as written,
sorted runs, each a bounded part of the corpus: local numbers of the phrases, in order of place,
beside the run's table of its distinct phrases. A phrase of k + 1 words is the merge join of two
occurrences of frequent phrases at adjacent places of one piece; both lie in one run, so no
occurrence is ever shuffled. Shuffled are the runs' counts of distinct phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from filmlake.operators.numbering import number_rows
from filmlake.session import broadcast_checked, materialize

from .common import partitions, slices
from .words import END, GAP, WORD, split_words

LONGEST = 3
LEAST_COUNT = 10
TOP = 2000
# A candidate goes if a longer one around it has this share, in per cent, of its occurrences.
ABSORBED = 50
# Characters of a run at most, unless one document has more.
RUN_CHARS = 2_000_000
# A reader of a relation holds so many runs at a time.
GROUP_RUNS = 4
# So many frequent phrases at most are sent to every task, 8 bytes each; more of them are joined.
MOST_SENT = 6_000_000
# The square of fewer numbers than this has at most 63 bits.
MOST_BELOW = 3_000_000_000
# Rankings meet in this many times fewer groups from one round to the next.
FAN_IN = 16

PLACES = np.zeros(256, np.uint8)
PLACES[[0x09, 0x20]] = GAP
PLACES[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = END
assert WORD == 0

_RUN = "lang string, words array<string>, n array<int>, gaps array<int>, codes array<int>"


def first_runs(docs: DataFrame, seed: int = 0, text: str = "text", lang: str = "lang") -> DataFrame:
    """The written relation of single words: (run, lang, words, n, gaps, codes, w0) of each run.

    ``codes`` are the occurrences in order, as numbers into ``words``, which occur ``n`` times; ``w0``
    has the words' 64-bit numbers, drawn by ``seed``.
    Places are counted by ``gaps``: 1 to the next word of the same piece, 2 over a piece's end. A run
    holds texts of one lang; null lang counts as ``und`` and null text as empty.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN_CHARS):
                names = part.column("lang").dictionary_encode()
                for number, name in enumerate(names.dictionary.to_pylist()):
                    chosen = pa.array(names.indices.to_numpy() == number)
                    words, codes, piece, _ = split_words(part.column("text").filter(chosen), PLACES)
                    if len(codes):
                        gaps = np.diff(piece, prepend=piece[0]) > 0
                        yield _one_row(
                            lang=name, words=words.cast(pa.string()), n=np.bincount(codes).astype(np.int32),
                            gaps=gaps.astype(np.int32) + 1, codes=codes,
                        )

    numbers = F.transform("words", lambda w: _number(seed, F.col("lang"), w))
    found = rows.mapInArrow(run, _RUN).withColumns({"run": F.monotonically_increasing_id(), "w0": numbers})
    return materialize(found, "words", GROUP_RUNS)


def _number(seed: int, lang: Column, word: Column) -> Column:
    return F.xxhash64(F.lit(seed), lang, word)


def _one_row(**columns: np.ndarray | pa.Array | str | int) -> pa.RecordBatch:
    """A batch of one row, whose arrays become lists."""

    def cell(value):
        if isinstance(value, (str, int)):
            return pa.array([value])
        values = value if isinstance(value, pa.Array) else pa.array(value)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_pydict({name: cell(value) for name, value in columns.items()})


def count_phrases(runs: DataFrame, least: int, below: int, name: str) -> DataFrame:
    """(first, last, f, id), written: the phrases that occur ``least`` times, numbered in order.

    A phrase is the pair of its first and its last words but one, by their numbers among the ``below``
    phrases one length below. A pair is shuffled as one number where that has 63 bits.
    """
    each = runs.select(F.inline(F.arrays_zip("first", "last", "n")))
    if below < MOST_BELOW:
        pair = (F.col("first") * F.lit(below) + F.col("last")).alias("pair")
        parts = F.expr(f"pair div {max(below, 1)}").alias("first"), (F.col("pair") % max(below, 1)).alias("last")
        counts = each.select(pair, "n").groupBy("pair").agg(F.sum("n").alias("f")).select(*parts, "f")
    else:
        counts = each.groupBy("first", "last").agg(F.sum("n").alias("f"))
    return materialize(number_rows(counts.filter(F.col("f") >= least), ["first", "last"], "id"), name)


def extend(runs: DataFrame, frequent: DataFrame, key: tuple[str, ...], below: int, most_sent: int, name: str) -> DataFrame:
    """The written relation of phrases one word longer whose both parts are ``frequent``.

    ``runs`` is first left with its occurrences of frequent phrases only: their keys are sent to the
    tasks, in the order of their numbers, if they are few enough, else joined to the tables of the
    runs. Either way a phrase gets its number and decides the same. ``below`` is how many phrases there
    are one length below, whose numbers make a ``key``.
    """
    columns = ["run", "gaps", "codes"]
    if frequent.count() <= most_sent and below <= most_sent:
        ordered = frequent.orderBy("id").select(_one_key(key, below).alias("key")).toArrow()
        sent = frequent.sparkSession.sparkContext.broadcast(ordered.column("key").to_numpy())
        rows = runs.select(*columns, *key)
    else:
        sent = None
        table = runs.select("run", F.posexplode(F.arrays_zip(*key)).alias("code", "p")).select("run", "code", "p.*")
        found = table.join(frequent.select(*key, "id"), list(key)).groupBy("run")
        found = found.agg(F.collect_list(F.struct("code", "id")).alias("p"))
        sized = runs.select(*columns, F.size(key[0]).alias("size"))
        rows = sized.join(found, "run").select(*columns, "size", F.col("p.code").alias("code"), F.col("p.id").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                value = {c: v.values.to_numpy() for c, v in row.items() if c not in ("run", "size")}
                if sent is None:
                    numbers = np.full(row["size"].as_py(), -1)
                    numbers[value["code"]] = value["id"]
                else:
                    wanted = value[key[0]] if len(key) == 1 else value[key[0]] * below + value[key[1]]
                    numbers = _places(sent.value, wanted)
                longer = _merge(value["gaps"], value["codes"], numbers)
                if longer is not None:
                    yield _one_row(run=row["run"].as_py(), **longer)

    schema = "run long, gaps array<int>, codes array<int>, n array<int>, first array<long>, last array<long>"
    return materialize(rows.mapInArrow(run, schema), name, GROUP_RUNS)


def _one_key(key: tuple[str, ...], below: int) -> Column:
    """One number of a phrase's key: exact, since ``below`` squared has less than 63 bits."""
    return F.col(key[0]) if len(key) == 1 else F.col(key[0]) * F.lit(below) + F.col(key[1])


def _places(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key is among the ordered ones, -1 for nowhere."""
    if not len(ordered):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def _merge(gaps: np.ndarray, codes: np.ndarray, numbers: np.ndarray) -> dict[str, np.ndarray] | None:
    """Merge a run with itself, one place on: the run of the longer phrases, None if there are none.

    ``numbers`` has the number of each phrase of the run's table, -1 if it is not frequent.
    """
    here = numbers[codes] >= 0
    place, codes = np.cumsum(gaps, dtype=np.int64)[here], codes[here].astype(np.int64)
    meets = np.flatnonzero(place[1:] == place[:-1] + 1)
    if not len(meets):
        return None
    size = len(numbers)
    pairs, again, n = np.unique(codes[meets] * size + codes[meets + 1], return_inverse=True, return_counts=True)
    return {
        "gaps": np.diff(place[meets], prepend=0).astype(np.int32), "codes": again.astype(np.int32),
        "n": n.astype(np.int32), "first": numbers[pairs // size], "last": numbers[pairs % size],
    }


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` candidates of each lang with their rank, found in rounds.

    Candidates are dealt at random over many groups of a lang, of which each keeps its first ones;
    these meet in fewer groups, until each lang is one. No group gets more than FAN_IN times ``top``
    rows from another round.
    """
    groups = partitions(rows.sparkSession)
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
    while True:
        first = W.partitionBy("lang", "group").orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
        if groups == 1:
            return rows.withColumn("rank", F.col("rank").cast("long")).drop("group")
        groups = -(-groups // FAN_IN)
        rows = rows.withColumn("group", F.pmod(F.col("group"), F.lit(groups)))


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = {c: f"cast({c} as decimal(38, 0))" for c in (a, left, right)}
    return F.expr(
        f"(cast(1000000 as decimal(38, 0)) * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]})"
    )


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, longest: int = LONGEST, most_sent: int = MOST_SENT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each lang.

    ``a``, ``l`` and ``r`` count the phrase and its parts before and after the lowest-scoring cut, ``n``
    the lang's words. A phrase that occurs half the time inside a longer candidate is left out. Ties
    go by ``a`` and then by phrase; repeated rows count each time; no row gives an empty result, a
    null text no words. Words are told apart by 64-bit numbers that are checked to be distinct; else
    others are drawn.
    """
    seed = 0
    while True:
        runs = first_runs(docs, seed)
        each = runs.select("lang", F.inline(F.arrays_zip("words", "n")))
        counts = each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("n").alias("f"))
        counts = materialize(counts, "word-counts")
        number = _number(seed, F.col("lang"), F.col("word")).alias("w0")
        if not counts.groupBy(number).count().filter("count > 1").limit(1).count():
            break
        seed += 1
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = counts.filter(F.col("f") >= least).select(number, "lang", "word", "f")
    phrases = {1: materialize(number_rows(words, ["w0"], "id"), "frequent-words")}
    below = 0
    for k in range(1, longest):
        key = ("w0",) if k == 1 else ("first", "last")
        runs = extend(runs, phrases[k], key, below, most_sent, f"phrases-{k + 1}")
        below = phrases[k].count()
        phrases[k + 1] = count_phrases(runs, least, below, f"frequent-{k + 1}")

    counted = F.array("f")
    named = phrases[1].select(
        "id", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("last_word"),
        counted.alias("beginnings"), counted.alias("ends"),
    )
    union = None
    for k in range(2, longest + 1):
        named = materialize(_named(phrases[k], named), f"named-{k}")
        kept = named if k == longest else _not_absorbed(named, phrases[k + 1])
        scored = kept.select("lang", "phrase", F.col("f").alias("a"), _lowest_cut(k).alias("cut"))
        scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        union = scored if union is None else union.unionByName(scored)
    ranked = _first_of_each(union, top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _named(frequent: DataFrame, below: DataFrame) -> DataFrame:
    """Frequent phrases with their words, and the counts of all their beginnings and ends.

    ``below`` has the same of the phrases one word shorter.
    """
    first = below.select(F.col("id").alias("first"), "lang", "phrase", "beginnings")
    last = below.select(F.col("id").alias("last"), "last_word", "ends")
    rows = frequent.join(broadcast_checked(first), "first").join(broadcast_checked(last), "last")
    whole = F.array("f")
    return rows.select(
        "id", "lang", "f", F.concat_ws(" ", "phrase", "last_word").alias("phrase"), "last_word",
        F.concat("beginnings", whole).alias("beginnings"), F.concat("ends", whole).alias("ends"),
    )


def _lowest_cut(k: int) -> Column:
    """(score, cut, l, r) of the lowest-scoring cut of a phrase of k words, the first of equal ones."""
    cuts = []
    for cut in range(1, k):
        left, right = f"beginnings[{cut - 1}]", f"ends[{k - cut - 1}]"
        parts = F.expr(left).alias("l"), F.expr(right).alias("r")
        cuts.append(F.struct(_score("f", left, right).alias("score"), F.lit(cut).alias("cut"), *parts))
    return F.array_min(F.array(*cuts))


def _not_absorbed(rows: DataFrame, longer: DataFrame) -> DataFrame:
    """The rows without those that a longer candidate has too large a share of.

    Of the longer candidates around a phrase those with one word more are the most frequent.
    """
    parts = longer.select("f", F.explode(F.array("first", "last")).alias("id"))
    around = parts.groupBy("id").agg(F.max("f").alias("most"))
    share = 100 * F.coalesce("most", F.lit(0)) < ABSORBED * F.col("f")
    return rows.join(around, "id", "left").filter(share)
