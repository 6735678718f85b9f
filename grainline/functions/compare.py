"""Comparisons with an explicit meaning for NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(c: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(c, F.lit(False))


def close_to(actual: Column, expected: Column, rtol: float = 0.01, atol: float = 1e-8) -> Column:
    """abs(actual - expected) <= atol + rtol * abs(expected), NULL read as 0.

    The tolerance follows ``expected`` only, so swapping the arguments changes the result.
    """
    a = F.coalesce(actual.cast("double"), F.lit(0.0))
    e = F.coalesce(expected.cast("double"), F.lit(0.0))
    return F.abs(a - e) <= F.lit(atol) + F.lit(rtol) * F.abs(e)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """100 * part / whole, rounded; NULL for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)
