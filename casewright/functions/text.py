"""Text predicates, recodes and the keyword classifier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from casewright import contracts as C
from casewright.functions.base import as_column, bound


def contains_any(text, needles) -> Column:
    """True when any literal needle occurs in the text."""
    text = as_column(text)
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def contains_none(text, needles) -> Column:
    return ~contains_any(text, needles)


def topic_of(text) -> Column:
    """First matching topic of the lower-cased text; null text counts as unmatched."""
    def ladder(low: Column) -> Column:
        found = F
        for topic, keywords in C.TOPIC_KEYWORDS:
            found = found.when(contains_any(low, keywords), F.lit(topic))
        return found.otherwise(F.lit(C.TOPIC_DEFAULT))

    return bound(F.lower(as_column(text)), ladder)


def is_mostly_ascii(text, threshold: float = 0.9) -> Column:
    """Share of ASCII characters at or above ``threshold``; false for null or empty.

    A character beyond ASCII takes one to three bytes more than one of ASCII, so the lengths in
    characters and bytes bound the share; only texts between the bounds have their characters counted.
    """
    def share(ascii_only: Column, chars: Column) -> Column:
        return F.try_divide(ascii_only, chars) >= threshold

    def settled(text: Column) -> Column:
        chars = F.length(text)
        more = F.octet_length(text) - chars
        valid = F.is_valid_utf8(text)
        counted = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
        return (
            F.when(valid & share(chars - more, chars), F.lit(True))
            .when(valid & ~share(chars - F.floor(more / 3), chars), F.lit(False))
            .otherwise(share(counted, chars))
        )

    return F.coalesce(bound(text, settled), F.lit(False))


def replace_literal(text, old: str, new: str) -> Column:
    return F.replace(as_column(text), F.lit(old), F.lit(new))


def corrected_office(office) -> Column:
    return replace_literal(office, *C.OFFICE_MISSPELLING)


def merged_category(category) -> Column:
    """General and miscellaneous tickets reported as one category."""
    category = as_column(category)
    return F.when(category.isin(*C.GENERAL_CATEGORIES), F.lit(C.GENERAL_LABEL)).otherwise(category)


def channel_of(mode, unmapped: str | None = None) -> Column:
    """Channel a mode belongs to; modes outside the map give ``unmapped``."""
    mode = as_column(mode)
    ladder = F
    for channel, modes in C.CHANNEL_MODES.items():
        ladder = ladder.when(mode.isin(*modes), F.lit(channel))
    return ladder.otherwise(F.lit(unmapped).cast("string"))


def flag_of(answer) -> Column:
    """Yes/No as boolean, everything else null (exact spelling)."""
    answer = as_column(answer)
    return F.when(answer == "Yes", F.lit(True)).when(answer == "No", F.lit(False))


def has_web_scheme(url) -> Column:
    low = F.lower(as_column(url))
    return F.coalesce(low.startswith("http://") | low.startswith("https://"), F.lit(False))
