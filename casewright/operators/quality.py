"""Constraint checks reported as data: not null, unique, foreign key, code domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright import contracts as C


def null_violations(table: DataFrame, columns) -> DataFrame:
    """(column_name, violations) for every checked column, counted in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "violations")


def unique_violations(table: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return table.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    The child is counted per key before the join, so a hot key costs one row.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return used.join(parent.select(key), key, "left_anti")


def domain_violations(table: DataFrame, status: str = "status", office: str = "office") -> DataFrame:
    """Rows whose status or office code is outside the known codes (null included)."""
    known = F.col(status).isin(*C.STATUSES) & F.col(office).isin(*C.OFFICES)
    return table.where(~F.coalesce(known, F.lit(False)))


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Insert-time defaults: add absent columns, fill null ones."""
    for name, value in defaults.items():
        current = F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value)
        rows = rows.withColumn(name, current)
    return rows


COMPLAINT_DEFAULTS = {"document_downloaded": False}
TRACKING_DEFAULTS = {"failure_count": 0}
