"""List-valued columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_item(items: Column) -> Column:
    """First item, NULL for an empty or missing list."""
    return F.get(items, F.lit(0))


def first_n(items: Column, n: int) -> Column:
    """Leading ``n`` items."""
    return F.slice(items, 1, n)


def as_list(value: Column) -> Column:
    """One-item list, NULL for NULL."""
    return F.when(value.isNotNull(), F.array(value))


def split_labels(text: Column) -> Column:
    """Comma-separated labels as a list."""
    return F.split(text, ", ")
