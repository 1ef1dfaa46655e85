"""Entity-dump dates and publication years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only time format an entity dump uses.
TIME_SHAPE = r"^\+\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def partial_date(text: Column) -> Column:
    """Date of ``+YYYY-MM-DDT00:00:00Z`` where day, or month and day, may be unknown.

    An impossible day falls back to the first of the month, then to 1 January. Text of any
    other shape, and the year 0000, give NULL.
    """
    usable = text.rlike(TIME_SHAPE) & (F.substring(text, 2, 4) != "0000")
    readings = [
        F.substring(text, 2, 10),
        F.concat(F.substring(text, 2, 8), F.lit("01")),
        F.concat(F.substring(text, 2, 5), F.lit("01-01")),
    ]
    return F.when(usable, F.coalesce(*[r.try_cast("date") for r in readings]))


def earliest_date(texts: Column) -> Column:
    """Earliest readable date of a list."""
    return F.array_min(F.transform(texts, partial_date))


def iso_year(text: Column) -> Column:
    """Year of an ISO date text."""
    return F.substring(text, 1, 4).try_cast("int")


def iso_epoch(text: Column) -> Column:
    """UTC epoch seconds at midnight of an ISO date text, whatever the session zone."""
    days = F.datediff(text.try_cast("date"), F.lit("1970-01-01").cast("date"))
    return days.cast("long") * F.lit(86400)
