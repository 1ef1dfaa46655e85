"""Licence scans: a trained paragraph classifier with an unknown class, confirmed by templates."""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "unknown"
# Paragraphs of the corpus that stand for "no licence" in the fit, at most.
NEGATIVES = 2_000
VARIANTS = 60
MOST_GRAM = 3
# A paragraph is judged in windows of so many words, half of which overlap.
WINDOW = 40
PROBABILITY, SIMILARITY = 0.5, 0.5
# Words missing or added inside a passage that follows a template, and families looked for where several share a window.
GAP, SHARED = 4, 4

# How the notices of each family are commonly worded.
TEMPLATES = {
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL v2 or later.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-SA": [
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced or distributed in any form without the prior written permission of the publisher.",
    ],
}
# Legal words in sentences that grant nothing.
OTHERWISE = [
    "He lost his driving license last year and walks to work now.",
    "The public was not allowed to work on the version that was distributed.",
    "All parts of the program were reserved for later.",
    "Permission to enter the building is given by the general office.",
    "The commons were free and the terms of the source were general.",
    "Their rights were discussed under the new terms in the following version.",
]
FUNCTION_WORDS = frozenset(
    "a an and any are as at be by can for from he his in is it its may not of on or that the their "
    "this to under was were will with you your".split()
)
TOKEN = re.compile(r"[^\W_]+(?:\.\d+)*")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def grams(words: list[str]) -> list[str]:
    """All word n-grams of one to MOST_GRAM words."""
    return [
        " ".join(words[at : at + n])
        for n in range(1, MOST_GRAM + 1)
        for at in range(len(words) - n + 1)
    ]


def _pairs(words: list[str]) -> frozenset:
    return frozenset(zip(words, words[1:])) or frozenset(words)


@dataclass(frozen=True)
class LicenceModel:
    """Families, the place of each known n-gram, weights (the last row is the bias), temperature."""

    families: tuple[str, ...]
    places: dict[str, int]
    weights: np.ndarray
    temperature: float
    legal: frozenset[str]

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = [self.places[g] for g in grams(words) if g in self.places]
        at, times = np.unique(np.array(known, np.int64), return_counts=True)
        return at, np.sqrt(times) / max(1.0, np.sqrt(len(words)))

    def probabilities(self, words: list[str]) -> np.ndarray:
        at, value = self.vector(words)
        z = (value @ self.weights[at] + self.weights[-1]) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def judge(self, words: list[str]) -> tuple[str, float, float]:
        """(family, probability, similarity to the family's nearest template) of a paragraph.

        A family whose probability or whose nearest template falls short is unknown.
        """
        p = self.probabilities(words)
        best = int(p.argmax())
        family, chance = self.families[best], float(p[best])
        own = _pairs(words)
        similarity = max(
            (
                len(own & other) / min(len(own), len(other))
                for other in (_pairs(tokens(t)) for t in TEMPLATES.get(family, ()))
            ),
            default=0.0,
        )
        if family == UNKNOWN or chance < PROBABILITY or similarity < SIMILARITY:
            return UNKNOWN, chance, similarity
        return family, chance, similarity


def _variant(words: list[str], noise: list[list[str]], rng: np.random.Generator) -> list[str]:
    """A template as it may be met: words missing, cut short, between other words."""
    kept = [w for w in words if len(words) < 6 or rng.random() > 0.08]
    if len(kept) > 12 and rng.random() < 0.5:
        begin = rng.integers(0, len(kept) // 3)
        kept = kept[begin : begin + max(10, int(len(kept) * 0.6))]
    if noise and rng.random() < 0.5:
        other = noise[rng.integers(len(noise))]
        cut = rng.integers(0, min(len(other), 12) + 1)
        kept = other[:cut] + kept + other[cut : cut + rng.integers(0, 8)]
    return kept


def fit_model(negatives: list[list[str]], seed: int = 11) -> LicenceModel:
    """Fit on variants of the templates, each family as often, and on paragraphs of the corpus.

    Three in ten examples are held out to set the temperature that makes the probabilities honest.
    """
    rng = np.random.default_rng(seed)
    families = (*TEMPLATES, UNKNOWN)
    examples: list[tuple[list[str], int]] = []
    for label, texts in enumerate(TEMPLATES.values()):
        for k in range(VARIANTS):
            examples.append((_variant(tokens(texts[k % len(texts)]), negatives, rng), label))
    for text in OTHERWISE:
        examples += [(_variant(tokens(text), negatives, rng), len(TEMPLATES)) for _ in range(VARIANTS // 4)]
    examples += [(words, len(TEMPLATES)) for words in negatives]
    vocabulary = sorted({g for texts in (*TEMPLATES.values(), OTHERWISE) for t in texts for g in grams(tokens(t))})
    legal = frozenset(
        w for texts in TEMPLATES.values() for t in texts for w in tokens(t)
        if w not in FUNCTION_WORDS and len(w) > 2 and not w[0].isdigit()
    )
    blank = LicenceModel(
        families,
        {g: k for k, g in enumerate(vocabulary)},
        np.zeros((len(vocabulary) + 1, len(families))),
        1.0,
        legal,
    )
    x = np.zeros((len(examples), len(vocabulary) + 1), np.float32)
    for row, (words, _) in enumerate(examples):
        at, value = blank.vector(words)
        x[row, at] = value
    x[:, -1] = 1.0
    y = np.eye(len(families), dtype=np.float32)[[label for _, label in examples]]
    held = rng.random(len(examples)) < 0.3
    x_fit, y_fit = x[~held], y[~held]
    weights, speed = np.zeros((x.shape[1], len(families)), np.float32), np.float32(0)
    for _ in range(200):
        z = x_fit @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = np.float32(0.9) * speed - (x_fit.T @ (p - y_fit) / len(p) + np.float32(1e-4) * weights)
        weights = weights + speed
    z = x[held] @ weights

    def loss(temperature: float) -> float:
        scaled = z / temperature
        top = scaled.max(axis=1, keepdims=True)
        log_p = scaled - top - np.log(np.exp(scaled - top).sum(axis=1, keepdims=True))
        return float(-(log_p * y[held]).sum())

    temperature = min(np.geomspace(0.2, 5, 60), key=loss)
    return LicenceModel(families, blank.places, weights, float(temperature), legal)


def fit(docs: DataFrame, text: str = "text", negatives: int = NEGATIVES) -> LicenceModel:
    """Fit the classifier; "no licence" is learnt from at most ``negatives`` lines of the corpus.

    The lines are drawn by a hash of their document's text and cut to one window; those that look
    like a notice (an n-gram of three words of a template) are left out of the sample.
    """
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    total = rows.count()
    share = min(1.0, negatives / 4 / max(total, 1))
    lines = (
        rows.filter(F.pmod(F.xxhash64("_text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
        .select(F.explode(F.split("_text", "\n")).alias("line"))
        .select(F.array_join(F.slice(F.split("line", " "), 1, WINDOW), " ").alias("line"))
        .filter("trim(line) <> ''")
        .distinct()
        .orderBy("line")
        .limit(negatives)
    )
    noticed = {" ".join(w) for ts in TEMPLATES.values() for t in ts for w in zip(*(tokens(t)[k:] for k in range(3)))}
    sample = [tokens(r["line"]) for r in lines.collect()]
    return fit_model([s for s in sample if s and noticed.isdisjoint(grams(s))])


def _core(words: list[str], family: str) -> tuple[int, int, int, float]:
    """(begin, end, pairs, share) of the words that one of the family's templates covers best.

    Pairs of neighbouring words that the template has count as one passage where they stand in its order
    and at most GAP words lie between them; ``pairs`` is the number of different ones in the passage,
    ``share`` that of all the template's.
    """
    found = (0, len(words), 0, 0.0)
    for template in TEMPLATES[family]:
        wanted = tokens(template)
        places: dict[tuple, list[int]] = {}
        for place, pair in enumerate(zip(wanted, wanted[1:])):
            places.setdefault(pair, []).append(place)
        passages: list[list[int]] = []
        last = -1  # the place in the template of the pair before
        for at, pair in enumerate(zip(words, words[1:])):
            if pair in places:
                later = [place for place in places[pair] if place > last]
                if not passages or not later or at - passages[-1][-1] > GAP + 1:
                    passages.append([])
                    later = places[pair]
                passages[-1].append(at)
                last = later[0]
        for passage in passages:
            pairs = len({(words[k], words[k + 1]) for k in passage})
            if (pairs, pairs / len(places)) > found[2:]:
                found = (passage[0], passage[-1] + 2, pairs, pairs / len(places))
    return found


def _peeled(words: list[str], at: int, model: LicenceModel, whole: bool) -> list[tuple]:
    """(begin, end, pairs, family, probability, similarity) of the notices in words from place ``at`` on.

    The words of a notice are set apart, and what stands before and after them is judged by itself. Where
    it is a licence but no family alone is sure, several share the words: each family's best passage is
    judged alone. Such a passage, and a remainder (not ``whole``), must cover half a template.
    """
    if model.legal.isdisjoint(words):
        return []
    judged = model.judge(words)
    begin, end, pairs, share = 0, len(words), 0, 0.0
    if judged[0] != UNKNOWN:
        begin, end, pairs, share = _core(words, judged[0])
    if judged[0] == UNKNOWN or not (whole or share >= SIMILARITY):
        p = model.probabilities(words)
        if 1 - p[-1] < PROBABILITY:
            return []
        for k in np.argsort(-p[:-1])[:SHARED]:
            begin, end, pairs, share = _core(words, model.families[k])
            judged = model.judge(words[begin:end])
            if judged[0] == model.families[k] and share >= SIMILARITY and end - begin < len(words):
                break
        else:
            return []
    return [
        *_peeled(words[:begin], at, model, False),
        (at + begin, at + end, pairs, *judged),
        *_peeled(words[end:], at + end, model, False),
    ]


def _paragraphs(text: str) -> Iterator[tuple[list[str], list[tuple[int, int]]]]:
    """(words, (line, place of its first word) of each line) of every run of lines that hold words.

    A line without words ends a paragraph: a blank one, a bare comment mark or a ruler. Marks that
    stand before the words of a line are no words, so a commented notice reads like a plain one.
    """
    words: list[str] = []
    starts: list[tuple[int, int]] = []
    for number, line in enumerate(text.split("\n")):
        own = tokens(line)
        if own:
            starts.append((number, len(words)))
            words += own
        elif words:
            yield words, starts
            words, starts = [], []
    if words:
        yield words, starts


def _windows(begin: int, end: int) -> range:
    """Where the windows of the words from ``begin`` to ``end`` start."""
    return range(begin, begin + max(1, end - begin - WINDOW // 2), WINDOW // 2)


def notices(text: str, model: LicenceModel) -> list[tuple[int, int, str, float, float]]:
    """(line, word, family, probability, similarity) of every notice in a text, in order.

    A paragraph is judged in overlapping windows, across its lines, so a notice may be wrapped; each of
    several lines is also judged by itself, since a short notice may stand between other text. Every notice
    of every window counts; words without a legal one have no feature that could speak for a family.
    Words belong to one notice: of those that share some, the one that covers most of a template stays.
    Notices of one family with less than half a window between them are one, the surest, and begin where
    the first of them does.
    """
    found = []
    for words, starts in _paragraphs(text):
        if model.legal.isdisjoint(words):
            continue
        ends = [*(place for _, place in starts[1:]), len(words)]
        windows = {(at, min(at + WINDOW, len(words))) for at in _windows(0, len(words))}
        for (_, begin), end in zip(starts, ends, strict=True):
            windows |= {(at, min(at + WINDOW, end)) for at in _windows(begin, end)}
        seen = {notice for at, end in windows for notice in _peeled(words[at:end], at, model, True)}
        apart: list[tuple] = []  # in order, no two share words
        for notice in sorted(seen, key=lambda x: (-x[2], -x[4], x)):
            place = bisect(apart, notice)
            before, after = apart[place - 1 : place], apart[place : place + 1]
            if all(x[1] <= notice[0] for x in before) and all(notice[1] <= x[0] for x in after):
                apart.insert(place, notice)
        last: dict[str, int] = {}  # the end of each family's notice before
        kept: dict[str, int] = {}  # and its place in found
        for begin, end, _, family, *sure in apart:
            if family in last and begin - last[family] < WINDOW // 2:
                if sure[0] > found[kept[family]][3]:
                    found[kept[family]] = (*found[kept[family]][:3], *sure)
            else:
                kept[family] = len(found)
                number, first = starts[bisect(starts, begin, key=lambda x: x[1]) - 1]
                found.append((number, begin - first, family, *sure))
            last[family] = end
    return found


def scan(
    docs: DataFrame,
    model: LicenceModel,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` and ``notices`` of every row: line, word, family, probability, similarity.

    A notice is placed by the line and the word where it begins, both counted from 0. Null and empty texts
    have no notice, repeated rows are all returned, other columns are not read.
    """
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    item = T.StructType(
        [
            T.StructField("line", T.IntegerType()),
            T.StructField("word", T.IntegerType()),
            T.StructField("family", T.StringType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    arrow = pa.list_(
        pa.struct(
            [("line", pa.int32()), ("word", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(item.names, n, strict=True)) for n in notices(t, model)]
                for t in batch.column("_text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(found, arrow)], [*keep, "notices"]
            )

    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("notices", T.ArrayType(item))])
    return rows.mapInArrow(run, schema)
