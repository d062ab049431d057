"""Schema conformance: variant records to typed rows, with a rejects trail.

One projection per record kind extracts every field, names every violated rule, and the
valid and rejected rows are two filters on the result. No Python runs here except the
office matcher, which sees only spellings that are not exact labels.
"""

from __future__ import annotations

from dataclasses import dataclass
from difflib import get_close_matches

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from casewright import contracts as C
from casewright.functions import dates
from casewright.functions.base import PIN, pinned, where_pinned

# --- office spelling ---------------------------------------------------------------------


def _office_matcher():
    """Closest label by sequence similarity. Each spelling of a batch is matched once; the
    function is self-contained, so executors need nothing but pandas."""
    labels, cutoff = list(C.OFFICES.values()), C.OFFICE_MATCH_CUTOFF

    def closest(spelling):
        found = get_close_matches(spelling, labels, n=1, cutoff=cutoff)
        return found[0] if found else None

    def closest_office(spellings: pd.Series) -> pd.Series:
        known = {s: closest(s) for s in spellings.dropna().unique()}
        return spellings.map(known).astype(object)

    return F.pandas_udf(closest_office, T.StringType())


def matched_office(office: Column) -> Column:
    """The known office a spelling stands for, null when none is close enough.

    Exact labels are settled by the built-in test; the matcher receives null for them.
    """
    exact = office.isin(*C.OFFICES.values())
    return F.when(exact, office).otherwise(_office_matcher()(F.when(~exact, office)))


# --- field rules --------------------------------------------------------------------------

_PROBLEMS = {
    "text": "not_text", "int": "not_int", "yes_no": "not_yes_no", "office": "unknown_office",
    "iso_time": "not_time", "action_time": "not_time",
}


def _value_and_error(field: C.Field) -> tuple[Column, Column]:
    """Typed value and violated rule of a field, over its extracted JSON type (null when
    the key is absent) and its text form."""
    json_type, text = F.col(f"_type_{field.name}"), F.col(f"_text_{field.name}")
    is_null = json_type == "VOID"
    string = F.when(json_type == "STRING", text)
    if field.kind == "any":
        typed = F.when(~is_null, text)
    elif field.kind == "int":
        # Whole numbers, also as text or with an empty fraction, and booleans.
        whole = F.when(F.trim(text).rlike("^[+-]?[0-9]+([.]0+)?$"), F.trim(text))
        typed = F.when(json_type == "BOOLEAN", (text == "true").cast("int")).otherwise(
            whole.try_cast("decimal(38,6)").try_cast("int")
        )
    elif field.kind == "yes_no":
        typed = F.when(string.isin("Yes", "yes"), F.lit(True)).when(
            string.isin("No", "no"), F.lit(False)
        )
    elif field.kind == "office":
        typed = matched_office(string)
    elif field.kind == "iso_time":
        typed = dates.parse_iso(string)
    elif field.kind == "action_time":
        typed = dates.parse_action_time(string)
    else:
        typed = string
    missing = F.when(json_type.isNull(), F.lit(f"{field.name}:missing"))
    if field.kind == "any" or (field.nullable and field.kind.endswith("time")):
        return typed, missing
    unread = json_type != "STRING" if field.kind == "text" else typed.isNull()  # a type tells without the text
    wrong = unread & ~is_null if field.nullable else unread
    return typed, missing.when(wrong, F.lit(f"{field.name}:{_PROBLEMS[field.kind]}"))


def conform(records: DataFrame, fields: tuple[C.Field, ...], record: str = "record",
            given: dict[str, str] | None = None) -> DataFrame:
    """Typed columns of every field plus ``errors`` (array of ``field:problem``).

    Other columns are carried along. ``given`` maps a field to a column that already
    holds its value (the ticket an action list was requested for). The result is pinned.
    """
    given = given or {}
    carried = [c for c in records.columns if c not in (record, *given.values())]
    read = [f for f in fields if f.name not in given]
    # The record is opened once, as a map, and each field looked up once; the rules only
    # look at the results. What is no object has no fields.
    opened = records.select(
        *carried, record, *given.values(), F.expr(f"TRY_CAST({record} AS MAP<STRING, VARIANT>) AS _fields"))
    fields_of = opened.select(
        *carried, record, *given.values(), *[F.expr(f"_fields['{f.wire}'] AS _value_{f.name}") for f in read])
    extracted = fields_of.select(
        *carried, record, *given.values(),
        *[F.expr(f"schema_of_variant(_value_{f.name}) AS _type_{f.name}") for f in read],
        *[F.expr(f"try_variant_get(_value_{f.name}, '$', 'string') AS _text_{f.name}") for f in read],
    )
    values, errors = [], []
    for field in fields:
        if field.name in given:
            values.append(F.col(given[field.name]).cast(C.field_type(field)).alias(field.name))
            continue
        typed, error = _value_and_error(field)
        values.append(typed.cast(C.field_type(field)).alias(field.name))
        errors.append(error)
    problems = F.array_compact(F.array(*errors)).alias("errors")
    return extracted.select(*pinned([*carried, record, *values, problems]))


@dataclass(frozen=True)
class Conformed:
    """``valid``: carried and typed columns. ``rejects``: carried columns, record, errors.
    Both filter ``checked``; use :func:`settled` when both are used."""

    valid: DataFrame
    rejects: DataFrame
    checked: DataFrame


def split_valid(checked: DataFrame, fields: tuple[C.Field, ...], record: str = "record") -> Conformed:
    names = {f.name for f in fields}
    ok = F.size("errors") == 0
    carried = [c for c in checked.columns if c not in names | {record, "errors", PIN}]
    return Conformed(
        where_pinned(checked, ok).drop(record, "errors"),
        where_pinned(checked, ~ok).select(*carried, F.to_json(record).alias(record), "errors"),
        checked,
    )


def settled(result: Conformed, path: str, record: str = "record") -> Conformed:
    """``result`` evaluated once, into Parquet at ``path``.

    A valid row leaves its record there and a rejected one its typed columns, so a text is
    written once and compressed; a cache would hold it twice and plain.
    """
    ok = F.size("errors") == 0
    carried = [c for c in result.rejects.columns if c not in (record, "errors")]
    typed = [F.when(ok, F.col(c)).alias(c) for c in result.valid.columns if c not in carried]
    rows = result.checked.select(*carried, *typed, F.when(~ok, F.to_json(record)).alias(record), "errors")
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    checked = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return Conformed(checked.where(ok).select(*result.valid.columns), checked.where(~ok).select(*result.rejects.columns), checked)


def conform_districts(records: DataFrame) -> Conformed:
    return split_valid(conform(records, C.DISTRICT_FIELDS), C.DISTRICT_FIELDS)


def conform_complaints(records: DataFrame) -> Conformed:
    return split_valid(conform(records, C.COMPLAINT_FIELDS), C.COMPLAINT_FIELDS)


def conform_actions(records: DataFrame, ticket: str = "request_ticket") -> Conformed:
    """Action records; the ticket comes from the request, not from the record."""
    checked = conform(records, C.ACTION_FIELDS, given={"ticket_no": ticket})
    return split_valid(checked, C.ACTION_FIELDS)
