"""Fetch tracking and backlog selection, all set-based.

``now`` is always a parameter and shares the clock of the stored fetch times. Tables
are unique on their keys, so every join here is one row to one row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from casewright import contracts as C
from casewright.functions import dates

Instant = Column | str | datetime
CELL_KEYS = list(C.CELL_KEYS)
TICKET_KEYS = ["ticket_no"]


# --- recording outcomes ---------------------------------------------------------------------


def record_outcomes(tracking: DataFrame, outcomes: DataFrame, keys: list[str], now: Instant, salts: int = 16) -> DataFrame:
    """Next tracking table after a run.

    ``outcomes`` holds the keys, ``outcome`` (``success`` or ``failure``), ``records``
    and ``attempt_seq``, in any number per key. A success sets fetch time and count and
    clears failures; each failure after the last success adds one and keeps the rest.
    """
    # A key's attempts are never gathered: they are dealt to (key, salt), the last success of
    # the key goes to each of its salts, and failures after it are counted there and summed.
    outcomes, won = outcomes.dropna(subset=keys), F.col("outcome") == "success"
    salt = F.pmod(F.xxhash64("attempt_seq", "records"), F.lit(salts)).cast("int").alias("_salt")
    last = outcomes.groupBy(*keys).agg(
        F.max(F.when(won, F.struct("attempt_seq", "records"))).alias("_won")
    )
    spread = last.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    failures = outcomes.where(~won).select(*keys, "attempt_seq", salt)
    later = F.col("_won").isNull() | (F.col("attempt_seq") > F.col("_won.attempt_seq"))
    failed = failures.join(spread, [*keys, "_salt"]).where(later).groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_failed"))
    folded = last.join(failed.groupBy(*keys).agg(F.sum("_failed").alias("_failed")), keys, "left")
    return _apply(tracking, folded, keys, now)


def record_successes(tracking: DataFrame, successes: DataFrame, keys: list[str], now: Instant) -> DataFrame:
    """Upsert: fetch time ``now``, count ``records``, failures 0. One row per key."""
    folded = successes.select(
        *keys, F.struct(F.lit(0).alias("attempt_seq"), "records").alias("_won"),
        F.lit(0).alias("_failed"),
    )
    return _apply(tracking, folded, keys, now)


def record_failures(tracking: DataFrame, failures: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: failures + 1 per failed attempt; success data kept."""
    folded = failures.groupBy(*keys).agg(F.count("*").alias("_failed")).withColumn(
        "_won", F.lit(None).cast("struct<attempt_seq:int,records:bigint>")
    )
    return _apply(tracking, folded, keys, F.lit(None).cast("timestamp_ntz"))


def _apply(tracking: DataFrame, folded: DataFrame, keys: list[str], now: Instant) -> DataFrame:
    joined = tracking.join(folded, keys, "full_outer")
    won = F.col("_won").isNotNull()
    base = F.when(won, F.lit(0)).otherwise(F.coalesce("failure_count", F.lit(0)))
    return joined.select(
        *keys,
        F.when(won, dates.instant(now)).otherwise(F.col("last_successful_fetch"))
        .cast("timestamp_ntz").alias("last_successful_fetch"),
        F.when(won, F.col("_won.records")).otherwise(F.col("records_count"))
        .cast("bigint").alias("records_count"),
        (base + F.coalesce("_failed", F.lit(0))).cast("bigint").alias("failure_count"),
    )


# --- selecting what to fetch ------------------------------------------------------------------


def request_grid(districts: DataFrame, years) -> DataFrame:
    """Every (year, dist_id, status, office) cell. Code lists are exploded per district."""
    def codes(values):
        return F.explode(F.array(*[F.lit(v) for v in values]))

    return (
        districts.select("dist_id")
        .withColumn("year", codes(years))
        .withColumn("status", codes(C.STATUSES))
        .withColumn("office", codes(C.OFFICES))
        .select(*CELL_KEYS)
    )


def cells_to_fetch(grid: DataFrame, tracking: DataFrame, now: Instant, days: int = 7,
                   failures: int = 3) -> DataFrame:
    """Cells without a success in the last ``days`` and with fewer than ``failures``."""
    cutoff = dates.days_before(now, days)
    recent = F.coalesce(F.col("last_successful_fetch") >= cutoff, F.lit(False))
    failing = F.coalesce(F.col("failure_count") >= failures, F.lit(False))
    return grid.join(tracking, CELL_KEYS, "left").where(~recent & ~failing).select(*CELL_KEYS)


def with_forced_cells(cells: DataFrame, forced: DataFrame) -> DataFrame:
    """Forced cells are appended as they are, duplicates included."""
    return cells.select(*CELL_KEYS).unionByName(forced.select(*CELL_KEYS))


def tickets_to_fetch(complaints: DataFrame, tracking: DataFrame, now: Instant, days: int = 7,
                     failures: int = 3) -> DataFrame:
    """Tickets whose action history is due: never tracked, or stale (or never fetched)
    with fewer than ``failures`` failures."""
    cutoff = dates.days_before(now, days)
    last = F.col("last_successful_fetch")
    due = F.col("_known").isNull() | (
        (F.col("failure_count") < failures) & (last.isNull() | (last < cutoff))
    )
    known = tracking.select(
        "ticket_no", "last_successful_fetch", "failure_count", F.lit(True).alias("_known")
    )
    return complaints.select("ticket_no").join(known, "ticket_no", "left").where(due).select("ticket_no")


def with_utc_fetch_time(tracking: DataFrame, zone: str = C.SOURCE_TIME_ZONE) -> DataFrame:
    """Fetch times that were stored as naive local time, as UTC wall time."""
    return tracking.withColumn(
        "last_successful_fetch", dates.local_to_utc("last_successful_fetch", zone)
    )


# --- folding a run -----------------------------------------------------------------------------


def fold_outcomes(attempts: DataFrame, records: DataFrame, keys: list[str],
                  empty_is_success: bool = False) -> DataFrame:
    """One outcome per attempted key from its landed records.

    ``attempts`` (unique keys, optional boolean ``failed``) are the requests made,
    ``records`` the rows they brought. No rows counts as a failure unless
    ``empty_is_success``, in which case only ``failed`` attempts do.
    """
    brought = records.groupBy(*keys).agg(F.count("*").alias("records"))
    joined = attempts.join(brought, keys, "left").withColumn(
        "records", F.coalesce("records", F.lit(0))
    )
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in attempts.columns else F.lit(False)
    success = F.col("records") > 0
    if empty_is_success:
        success = success | ~failed
    return joined.select(
        *keys, F.when(success, F.lit("success")).otherwise(F.lit("failure")).alias("outcome"),
        "records", F.lit(0).alias("attempt_seq"),
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count_if(F.col("outcome") == "success").alias("success_count"),
        F.count_if(F.col("outcome") == "failure").alias("failure_count"),
    )
