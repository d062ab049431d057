"""Names of stored documents: building them and reading tickets back from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright import contracts as C
from casewright.functions.base import as_column


def url_extension(url) -> Column:
    """Lower-cased letters after the last ``~``; ``bin`` when the url has no such tail.

    A url that ends in ``~`` has an empty extension.
    """
    url = as_column(url)
    return F.when(
        url.rlike(C.URL_EXTENSION), F.lower(F.regexp_extract(url, C.URL_EXTENSION, 1))
    ).when(url.isNotNull(), F.lit("bin"))


def document_name(ticket, document_type, url, now) -> Column:
    """``{ticket}_{type}_{yyyyMMdd_HHmmss}.{ext}``; null without ticket or url."""
    return F.concat(
        as_column(ticket), F.lit("_"), as_column(document_type), F.lit("_"),
        F.date_format(as_column(now), "yyyyMMdd_HHmmss"), F.lit("."), url_extension(url),
    )


def ticket_in_name(name) -> Column:
    """Ticket number found in a stored file name, null when there is none."""
    found = F.regexp_extract(as_column(name), C.TICKET_IN_NAME, 0)
    return F.nullif(found, F.lit(""))


def stored_ticket(name, document_type: str) -> Column:
    """Ticket part of ``{ticket}_{type}_*.{ext}``, null for other names."""
    pattern = rf"^(.*?)_{document_type}_.*\.[^.]*$"
    return F.nullif(F.regexp_extract(as_column(name), pattern, 1), F.lit(""))


def stored_extension(name) -> Column:
    return F.regexp_extract(as_column(name), r"\.([^.]*)$", 1)


def base_name(path) -> Column:
    return F.element_at(F.split(as_column(path), "/"), -1)
