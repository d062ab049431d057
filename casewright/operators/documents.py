"""Document columns: what to fetch, under which name, and what came of it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions import dates, naming, text as tx
from casewright.operators import lookup
from casewright.operators.merge import first_in_batch

Instant = Column | str | datetime


def with_document_name(complaints: DataFrame, now: Instant, document_type: str = "complaint",
                       folder: str | None = None) -> DataFrame:
    """Adds ``document_name``, below ``folder`` when given; null without a url."""
    name = naming.document_name("ticket_no", F.lit(document_type), "document_url", dates.instant(now))
    if folder is not None:
        name = F.concat(F.lit(folder.rstrip("/") + "/"), name)
    return complaints.withColumn("document_name", name)


def with_valid_url(complaints: DataFrame) -> DataFrame:
    return complaints.where(tx.has_web_scheme("document_url"))


def _stored(listing: DataFrame, document_type: str, any_case: bool) -> DataFrame:
    extension = naming.stored_extension("name")
    return (
        listing.select(
            naming.stored_ticket("name", document_type).alias("ticket_no"),
            (F.lower(extension) if any_case else extension).alias("_ext"),
        )
        .where(F.col("ticket_no").isNotNull()).distinct()
    )


def _by_stored(complaints: DataFrame, listing: DataFrame, document_type: str, any_case: bool,
               how: str) -> DataFrame:
    return (
        complaints.withColumn("_ext", naming.url_extension("document_url"))
        .join(_stored(listing, document_type, any_case), ["ticket_no", "_ext"], how)
        .select(*complaints.columns)
    )


def already_stored(complaints: DataFrame, listing: DataFrame, document_type: str = "complaint",
                   any_case: bool = False) -> DataFrame:
    """Tickets with a stored document of this type and extension, whatever its time.

    ``any_case`` ignores the case of the stored extension, as the object-store check does.
    """
    return _by_stored(complaints, listing, document_type, any_case, "left_semi")


def not_stored(complaints: DataFrame, listing: DataFrame, document_type: str = "complaint",
               any_case: bool = False) -> DataFrame:
    return _by_stored(complaints, listing, document_type, any_case, "left_anti")


def download_plan(complaints: DataFrame, listing: DataFrame, now: Instant,
                  document_type: str = "complaint", failed_before: bool = False,
                  any_case: bool = False) -> DataFrame:
    """What an external fetcher should get: ``ticket_no, document_url, document_name``."""
    due = with_valid_url(lookup.without_documents(complaints, failed_before))
    missing = not_stored(due, listing, document_type, any_case)
    return with_document_name(missing, now, document_type).select(
        "ticket_no", "document_url", "document_name"
    )


def pending_tickets(complaints: DataFrame, listing: DataFrame) -> DataFrame:
    """Tickets with a url for which no stored name mentions the ticket."""
    stored = listing.select(naming.ticket_in_name("name").alias("ticket_no")).where(
        F.col("ticket_no").isNotNull()
    )
    wanted = lookup.with_document_urls(complaints).select("ticket_no").distinct()
    return wanted.join(stored.distinct(), "ticket_no", "left_anti")


def first_pending(pending: DataFrame, count: int) -> DataFrame:
    """A work list of at most ``count`` tickets, the lowest ticket numbers first."""
    return pending.orderBy("ticket_no").limit(count)


def classify_attempts(attempts: DataFrame) -> DataFrame:
    """Adds ``status``: an error is ``failed``, a path ``success``, neither ``skipped``."""
    status = (
        F.when(F.col("error").isNotNull(), F.lit("failed"))
        .when(F.col("local_path").isNotNull(), F.lit("success"))
        .otherwise(F.lit("skipped"))
    )
    return attempts.withColumn("status", status)


def last_statuses(attempts: DataFrame, seq: str = "attempt_seq") -> DataFrame:
    """Status of the last attempt per ticket."""
    return classify_attempts(attempts).groupBy("ticket_no").agg(
        F.max_by("status", seq).alias("status")
    )


def updates_from_attempts(attempts: DataFrame, seq: str = "attempt_seq") -> DataFrame:
    """Update rows for :func:`apply_updates`."""
    classified = classify_attempts(attempts)
    return classified.select(
        "ticket_no", F.when(F.col("status") == "success", F.col("local_path")).alias("local_path"),
        (F.col("status") == "success").alias("success"), "error", seq,
    )


def apply_updates(complaints: DataFrame, updates: DataFrame, now: Instant, *, seq: str = "attempt_seq",
                  skip_clears: bool = True, always_date: bool = False) -> DataFrame:
    """Complaints with the outcome columns set; the first update per ticket counts.

    The date moves on success only (``always_date`` moves it on any outcome). A skipped
    update (no path, no error, not successful) clears path and flag; ``skip_clears=False``
    leaves such tickets untouched.
    """
    first = first_in_batch(updates, ["ticket_no"], seq)
    if not skip_clears:
        first = first.where(F.col("success") | F.col("error").isNotNull())
    joined = complaints.join(
        first.select(
            "ticket_no", "local_path", "success", "error", F.lit(True).alias("_hit")
        ), "ticket_no", "left",
    )
    hit = F.col("_hit").isNotNull()
    dated = hit if always_date else hit & F.col("success")
    new_values = {
        "local_document_path": F.when(hit, F.col("local_path")).otherwise(F.col("local_document_path")),
        "document_downloaded": F.when(hit, F.col("success")).otherwise(F.col("document_downloaded")),
        "document_download_date": F.when(dated, dates.instant(now)).otherwise(F.col("document_download_date")),
        "document_download_error": F.when(hit, F.col("error")).otherwise(
            F.col("document_download_error")
        ),
    }
    return joined.withColumns(new_values).select(*complaints.columns)


def update_status(complaints: DataFrame, ticket: str, path: str | None, success: bool,
                  now: Instant, error: str | None = None) -> DataFrame:
    """One ticket's outcome, dated even on failure; an unknown ticket changes nothing."""
    hit = F.col("ticket_no") == ticket
    values = {
        "local_document_path": F.lit(path).cast("string"),
        "document_downloaded": F.lit(success),
        "document_download_date": dates.instant(now),
        "document_download_error": F.lit(error).cast("string"),
    }
    return complaints.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}
    )
