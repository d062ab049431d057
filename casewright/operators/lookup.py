"""Lookups, filters and projections on conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.functions import text as tx


def district_by_id(districts: DataFrame, dist_id: int) -> DataFrame:
    return districts.where(F.col("dist_id") == dist_id).orderBy("dist_name").limit(1)


def district_by_name(districts: DataFrame, name: str) -> DataFrame:
    return districts.where(F.col("dist_name") == name).orderBy("dist_id").limit(1)


def complaint_by_ticket(complaints: DataFrame, ticket: str) -> DataFrame:
    return complaints.where(F.col("ticket_no") == ticket).orderBy(*complaints.columns).limit(1)


def complaints_by_district(complaints: DataFrame, district: str) -> DataFrame:
    return complaints.where(F.col("district") == district)


def complaints_by_status(complaints: DataFrame, status: str) -> DataFrame:
    return complaints.where(F.col("status") == status)


def actions_by_ticket(actions: DataFrame, ticket: str) -> DataFrame:
    return actions.where(F.col("ticket_no") == ticket)


def without_documents(complaints: DataFrame, failed_before: bool = False) -> DataFrame:
    """Tickets with a document url that is not stored yet.

    ``failed_before`` picks those whose last attempt left an error instead of those
    without one. An unknown download flag (null) is not picked.
    """
    error = F.col("document_download_error")
    return complaints.where(
        ~F.col("document_url").isin("", "N/A")
        & (F.col("document_downloaded") == F.lit(False))
        & (error.isNotNull() if failed_before else error.isNull())
    )


def with_document_urls(complaints: DataFrame) -> DataFrame:
    """All but empty urls; a null url is kept, as the null-safe comparison does."""
    return complaints.where(~F.col("document_url").eqNullSafe(""))


def existing_in_batch(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` (unique on ``key``) whose key is in the batch."""
    return table.join(batch.select(key).distinct(), key, "left_semi")


def tickets_where(tickets: DataFrame, *, modes=None, office=None, status_id=None,
                  benefitted=None, contains=None, contains_none=None) -> DataFrame:
    """Conjunction of the analytic predicates that are given."""
    if modes is not None:
        tickets = tickets.where(F.col("mode").isin(*modes))
    if office is not None:
        tickets = tickets.where(F.col("office") == office)
    if status_id is not None:
        tickets = tickets.where(F.col("status_id") == status_id)
    if benefitted is not None:
        tickets = tickets.where(F.col("benefitted") == benefitted)
    if contains is not None:
        tickets = tickets.where(tx.contains_any("complaint_text", contains))
    if contains_none is not None:
        tickets = tickets.where(tx.contains_none("complaint_text", contains_none))
    return tickets


def renamed(table: DataFrame, names: dict[str, str] | None = None, prefix: str = "",
            suffix: str = "", keep=()) -> DataFrame:
    """Rename by map, then add a prefix or suffix to all columns but ``keep``."""
    if names:
        table = table.withColumnsRenamed(names)
    return table.select(
        *[F.col(c) if c in keep else F.col(c).alias(f"{prefix}{c}{suffix}") for c in table.columns]
    )


def with_recodes(tickets: DataFrame, unmapped: str = "Urgent") -> DataFrame:
    """Adds ``channel`` and ``benefitted_bool``, merges the general categories."""
    return tickets.withColumns({
        "channel": tx.channel_of("mode", unmapped),
        "benefitted_bool": tx.flag_of("benefitted"),
        "category": tx.merged_category("category"),
    })
