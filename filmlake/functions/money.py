"""Profit and inflation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Yearly growth of prices in dollars, and the year money is expressed in.
YEARLY_GROWTH = 1.0297
BASE_YEAR = 2019


def profit(nbox: Column, ncost: Column) -> Column:
    """Box office minus cost."""
    return nbox - ncost


def made_profit(nbox: Column, ncost: Column) -> Column:
    """True, false, or NULL where either amount is unknown."""
    return profit(nbox, ncost) > 0


def money_value(
    year: Column, growth: float = YEARLY_GROWTH, base_year: int = BASE_YEAR
) -> Column:
    """What one unit of money of ``year`` is worth in ``base_year``."""
    return F.pow(F.lit(growth), F.lit(base_year) - year)


def profit_rate(real_profit: Column, real_cost: Column) -> Column:
    """Profit per unit of cost, NULL at zero cost."""
    return F.try_divide(real_profit, real_cost)
