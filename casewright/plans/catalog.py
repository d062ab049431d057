"""All registered queries."""

from casewright.plans import (  # noqa: F401
    explore_queries, ingest_queries, report_queries, sink_queries, stream_queries, table_queries,
)
from casewright.plans.registry import ENTRIES, Entry

__all__ = ["ENTRIES", "Entry"]
