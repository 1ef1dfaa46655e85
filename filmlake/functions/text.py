"""Plot text: cleaning, tokens, stop words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_RUN = r"([\p{L}\p{N}_]+)"
LONG_WORD_RUN = r"([\p{L}\p{N}_]{2,})"


def clean_text(text: Column) -> Column:
    """Letters only, lower case, single spaces; apostrophes vanish without a space."""
    letters = F.regexp_replace(F.replace(text, F.lit("'"), F.lit("")), "[^a-zA-Z]+", " ")
    return F.lower(F.trim(letters))


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of word characters of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_RUN), F.lit(1))


def long_word_tokens(text: Column) -> Column:
    """Lower-cased runs of at least two word characters, the unit of the term weights."""
    return F.regexp_extract_all(F.lower(text), F.lit(LONG_WORD_RUN), F.lit(1))


def clean_tokens(cleaned: Column) -> Column:
    """Words of text that went through :func:`clean_text`; an empty text has none."""
    return F.filter(F.split(cleaned, " "), lambda t: F.length(t) > 0)


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are not on a given short list."""
    banned = sorted(set(words))
    return F.filter(tokens, lambda t: ~t.isin(banned)) if banned else tokens


def join_tokens(tokens: Column) -> Column:
    """Kept tokens as text again."""
    return F.array_join(tokens, " ")


def fingerprint(text: Column) -> Column:
    """Digest that stands for a long text where only equality matters."""
    return F.sha2(text, 256)
