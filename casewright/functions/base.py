from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def as_column(value) -> Column:
    """Column names and columns are both accepted by every function here."""
    return F.col(value) if isinstance(value, str) else value


def bound(value, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    An expression that a filter names several times is otherwise evaluated each time, as are the
    projections it is pushed through.
    """
    return F.transform(F.array(as_column(value)), use)[0]


PIN = "_pinned"


def pinned(columns: list) -> list:
    """Columns of a costly projection, with a row number that keeps it in one piece.

    A filter on a computed column is otherwise pushed below its projection and evaluates
    the whole expression a second time. Filter such a projection with :func:`where_pinned`.
    """
    return [*columns, F.monotonically_increasing_id().alias(PIN)]


def where_pinned(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.where(condition & (F.col(PIN) >= 0)).drop(PIN)
