"""Points for an award summary sentence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrase patterns and their weights.
AWARD_PATTERNS = (
    r"Won (\d+) Oscar",
    r"Nominated for (\d+) Oscar",
    r"Won (\d+) Golden",
    r"Nominated for (\d+) Golden",
    r"(\d+) win",
    r"(\d+) nomination",
)
AWARD_WEIGHTS = (10.0, 5.0, 7.0, 3.0, 1.0, 0.25)
EARLY_AWARD_WEIGHTS = (5.0, 3.0, 4.0, 2.0, 1.0, 0.25)


def awards_score(text: Column, weights: Sequence[float] = AWARD_WEIGHTS) -> Column:
    """Weighted sum of the first number each phrase carries; 0 for no phrase or NULL."""
    terms = [
        F.coalesce(F.regexp_extract(text, p, 1).try_cast("int"), F.lit(0)) * F.lit(float(w))
        for p, w in zip(AWARD_PATTERNS, weights, strict=True)
    ]
    return sum(terms[1:], terms[0])
