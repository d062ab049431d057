"""Numeric helpers: half-even rounding, percentages, conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright.functions.base import as_column


def rounded(value, digits: int = 0) -> Column:
    """Half-even rounding, as published figures use."""
    return F.bround(as_column(value).cast("double"), digits)


def percent(part, whole, digits: int | None = 1) -> Column:
    """``part / whole * 100``; null when ``whole`` is 0."""
    value = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double")) * 100
    return value if digits is None else rounded(value, digits)


def zero_if_null(value) -> Column:
    return F.coalesce(as_column(value), F.lit(0.0))


def null_if_zero(value) -> Column:
    return F.nullif(as_column(value), F.lit(0))


def mean_where(condition: Column, value) -> Column:
    return F.avg(F.when(condition, as_column(value)))
