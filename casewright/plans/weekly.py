"""The weekly run as data: what to fetch, what landed, what is still missing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import contracts as C
from casewright.functions import dates
from casewright.operators import documents, report_cube, tracking
from casewright.sources.tables import Table, open_table, write_reports


def open_tables(spark: SparkSession, root: str) -> dict[str, Table]:
    return {name: open_table(spark, root, name) for name in C.UNIQUE_KEYS}


def _moment(now: datetime | str):
    """Microseconds of ``now``, by which later runs win."""
    return F.unix_micros(dates.instant(now).cast("timestamp"))


def plan_complaint_requests(tables: dict[str, Table], years, now: datetime | str,
                            forced: DataFrame | None = None, days: int = 7,
                            failures: int = 1) -> DataFrame:
    """Cells an external fetcher should request."""
    grid = tracking.request_grid(tables["districts"].read(), years)
    due = tracking.cells_to_fetch(grid, tables["cell_tracking"].read(), now, days, failures)
    return due if forced is None else tracking.with_forced_cells(due, forced)


def plan_action_requests(tables: dict[str, Table], now: datetime | str) -> DataFrame:
    """Tickets whose action history an external fetcher should request."""
    return tracking.tickets_to_fetch(
        tables["complaints"].read(), tables["ticket_tracking"].read(), now
    )


def plan_downloads(tables: dict[str, Table], listing: DataFrame, now: datetime | str) -> DataFrame:
    return documents.download_plan(tables["complaints"].read(), listing, now)


def record_requests(table: Table, attempts: DataFrame, landed: DataFrame, keys: list[str],
                    now: datetime | str, empty_is_success: bool = False) -> DataFrame:
    """Fold a run's landed records into the tracking table; returns the totals.

    Only the attempted keys are written, under the time of the run.
    """
    outcomes = tracking.fold_outcomes(attempts, landed, keys, empty_is_success)
    run = ("requests", str(now).replace(" ", "_").replace(":", ""))
    known = table.read(without=run).join(outcomes.select(*keys).distinct(), keys, "left_semi")
    table.append(tracking.record_outcomes(known, outcomes, keys, now), *run, _moment(now))
    return tracking.outcome_totals(outcomes)


def record_downloads(complaints: Table, attempts: DataFrame, now: datetime | str, skip_clears: bool = True) -> None:
    """Apply download attempts to the document columns of the complaint table.

    Only the attempted tickets are written, under the time of the run.
    """
    run = ("downloads", str(now).replace(" ", "_").replace(":", ""))
    known = complaints.read(without=run).join(attempts.select("ticket_no").distinct(), "ticket_no", "left_semi")
    updated = documents.apply_updates(
        known, documents.updates_from_attempts(attempts), now, skip_clears=skip_clears)
    complaints.append(updated, *run, _moment(now), group="outcome")


def publish_reports(tickets: DataFrame, as_of: datetime | str, root: str) -> dict[str, str]:
    """Compute the report set over the analysis table and write each report.

    The tickets are read once, for the cube below ``root``; every report is cut from that.
    """
    folder = f"{root}/_cube"
    report_cube.cube(tickets, as_of).write.mode("errorifexists").parquet(folder)
    return write_reports(report_cube.report_catalogue(tickets.sparkSession.read.parquet(folder)), root)
