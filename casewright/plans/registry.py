"""Registry of runnable queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``run(spark, sf_dir)`` under ``name``, with equivalent SQL if there is one."""
    def add(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, run, sql)
        return run
    return add


def with_ctes(*parts: str) -> str:
    """``WITH`` the leading parts as common table expressions; the last is the select."""
    *ctes, select = parts
    return f"WITH {', '.join(ctes)} {select}" if ctes else select
