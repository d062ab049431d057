"""Data contracts: wire names, column types, dimensions and recode tables.

Everything in the "Fixed values" sections must equal what the upstream service sends
or what published reports use, so it is stated here once as plain data. Logic lives
elsewhere and reads these tables.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

#: Values of the source that are kept apart as plain data.
WIRE_VALUES = json.loads(Path(__file__).with_name("wire_values.json").read_text())


@dataclass(frozen=True)
class Field:
    """One field of a record kind.

    ``kind`` selects the conformance rule: ``text``, ``any``, ``int``, ``yes_no``,
    ``office``, ``iso_time`` or ``action_time``. ``nullable`` says whether a JSON null
    is accepted; the key itself is always required. ``late`` fields are not carried by
    newly registered (status 0) tickets.
    """

    name: str
    wire: str
    kind: str
    nullable: bool
    late: bool = False


# --- Fixed values: wire contract of the complaint record (misspellings included) ------
COMPLAINT_FIELDS: tuple[Field, ...] = (
    Field("ticket_no", "ticketNumber", "text", False),
    Field("petitioner_name", "petitionerName", "text", True),
    Field("petitioner_mobile", "petitionerMobile", "text", True),
    Field("petitioner_email", "petitionerEmail", "text", True),
    Field("complaint_text", WIRE_VALUES["complaint_text_key"], "text", False),
    Field("document_url", "Document", "text", False, late=True),
    Field("office", "officeNAme", "office", False),
    Field("received_by", "RecievedByOfficerName", "text", False),
    Field("district", "districtName", "text", False),
    Field("block", "blockName", "text", True),
    Field("address", "Address", "text", True),
    Field("mode", "modeName", "text", False),
    Field("disability", "disbilityName", "text", True),
    Field("status", "StatusName", "text", False),
    Field("govt_ticket", "govtTicket", "yes_no", False),
    Field("created_on", "CreatedOn", "iso_time", False),
    Field("tagged_to", "taggedTo", "any", True),
    Field("tagged_by", "taggedByName", "any", True),
    Field("tagged_date", "taggedDate", "iso_time", True),
    Field("category", "category", "text", False),
    Field("dept", "deptName", "text", True),
    Field("subcategory", "Subcategory", "text", True),
    Field("state", "stateName", "text", False),
    Field("petitioner_gender", "genderName", "text", False),
    Field("transfer_status", "transferStatus", "text", False),
    Field("urgent", "mostUrgent", "text", False),
    Field("pending_with", "pendingwithName", "text", True, late=True),
    Field("assigned_on", "assignedOn", "iso_time", False, late=True),
    Field("escalation_date", "escalationDate", "iso_time", True, late=True),
    Field("self_assign", "isSelfAssign", "text", True, late=True),
    Field("resolved_on", "ResolvedOn", "iso_time", True, late=True),
    Field("benefitted", "benefitted", "text", True, late=True),
)

DISTRICT_FIELDS: tuple[Field, ...] = (
    Field("dist_id", "distId", "int", False),
    Field("dist_name", "distName", "text", False),
)

ACTION_FIELDS: tuple[Field, ...] = (
    Field("ticket_no", "ticketNumber", "text", False),
    Field("action_taken_by", "action_taken_by", "text", False),
    Field("action_taken_date", "action_taken_date", "action_time", True),
    Field("action_taken_remark", "action_taken_remark", "text", False),
    Field("action_status", "action_status", "text", False),
    Field("complaint_status_with_authority", "complaint_status_with_authority", "text", False),
)

# Envelope keys that may carry the record list, in order of precedence.
ENVELOPE_KEYS = ("distRes", "Res", "actionHistory")

# --- Fixed values: dimensions ----------------------------------------------
STATUSES = {0: "To be assigned", 1: "Assigned but pending", 2: "Disposed"}
OFFICES = {
    1: "Office of Chief Minister",
    2: "Governor",
    3: "Chief Secretary",
    4: "DG & IG Police",
    5: "Departments",
    6: "Collector",
    7: "Superintendent of Police",
}
OFFICE_MATCH_CUTOFF = 0.6

# --- Fixed values: recodes ------------------------------------------------------------
CHANNEL_MODES = {
    "online": ("Website", "Whatsapp", "Mobile"),
    "offline": ("Joint Hearing", "Physical", WIRE_VALUES["weekly_mode"]),
    "freetext": ("Letter", "Email"),
}
GENERAL_CATEGORIES = ("General", "Miscellaneous")
GENERAL_LABEL = "General & Misc"
OFFICE_MISSPELLING = ("Supertendent of Police", "Superintendent of Police")

# First matching class wins; keywords are looked up in lower-cased text.
TOPIC_KEYWORDS = (
    ("Housing", ("pmay", "pmagy", "housing", "awas", "yojana", "yojna", "house")),
    ("Subhadra Scheme", ("subhadra",)),
    ("Ration Card", ("ration card",)),
)
TOPIC_DEFAULT = "Other"

# --- Fixed values: action statuses ------------------------------------------------------
ACTION_STATUSES = (
    "Complaint Assigned",
    "Complaint Pullback",
    "Complaint Register",
    "Complaint Transfer",
    "Discard",
    "Forward",
    "Forwarded To Subordinate",
    "Reminder Sent",
    "Reopen",
    "Replied",
)
FORWARDING_STATUSES = ("Complaint Register", "Forward", "Forwarded To Subordinate")

# --- Fixed values: defaults and name patterns ------------------------------------------
DEFAULT_AS_OF = "2025-06-22"
SOURCE_TIME_ZONE = "Asia/Kolkata"
TICKET_IN_NAME = r"([A-Z]{2,4}[0-9]*)(_compliant)*"
URL_EXTENSION = r"~([a-zA-Z]*)$"

# --- Table schemas ---------------------------------------------------------------------
_KIND_TYPES = {
    "text": T.StringType(),
    "any": T.StringType(),
    "office": T.StringType(),
    "int": T.IntegerType(),
    "yes_no": T.BooleanType(),
    "iso_time": T.TimestampNTZType(),
    "action_time": T.TimestampNTZType(),
}


def field_type(field: Field) -> T.DataType:
    return _KIND_TYPES[field.kind]


def _struct(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, field_type(f), True) for f in fields])


DISTRICT_SCHEMA = _struct(DISTRICT_FIELDS)
ACTION_SCHEMA = _struct(ACTION_FIELDS)
RECORD_SCHEMA = _struct(COMPLAINT_FIELDS)

DOCUMENT_COLUMNS = (
    "local_document_path",
    "document_downloaded",
    "document_download_date",
    "document_download_error",
)
COMPLAINT_SCHEMA = T.StructType(
    RECORD_SCHEMA.fields
    + [
        T.StructField("local_document_path", T.StringType()),
        T.StructField("document_downloaded", T.BooleanType()),
        T.StructField("document_download_date", T.TimestampNTZType()),
        T.StructField("document_download_error", T.StringType()),
    ]
)

_MEASURES = [
    T.StructField("last_successful_fetch", T.TimestampNTZType()),
    T.StructField("records_count", T.LongType()),
    T.StructField("failure_count", T.LongType()),
]
CELL_KEYS = ("year", "dist_id", "status", "office")
CELL_TRACKING_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType()) for k in CELL_KEYS] + _MEASURES
)
TICKET_TRACKING_SCHEMA = T.StructType([T.StructField("ticket_no", T.StringType())] + _MEASURES)

ACTION_KEY = (
    "ticket_no",
    "action_taken_by",
    "action_status",
    "action_taken_remark",
    "complaint_status_with_authority",
)

# Not-null columns per table. The tables allow a null document url and a null action
# remark although the record contracts do not.
REQUIRED_COLUMNS = {
    "districts": ("dist_id", "dist_name"),
    "complaints": tuple(
        f.name for f in COMPLAINT_FIELDS if not f.nullable and f.name != "document_url"
    ),
    "action_history": tuple(
        f.name for f in ACTION_FIELDS if not f.nullable and f.name != "action_taken_remark"
    ),
    "cell_tracking": CELL_KEYS + ("failure_count",),
    "ticket_tracking": ("ticket_no", "failure_count"),
}
UNIQUE_KEYS = {
    "districts": ("dist_id",),
    "complaints": ("ticket_no",),
    "action_history": ACTION_KEY,
    "cell_tracking": CELL_KEYS,
    "ticket_tracking": ("ticket_no",),
}

# Columns of the analysis table that newly registered (status 0) tickets carry.
UNASSIGNED_COLUMNS = tuple(f.name for f in COMPLAINT_FIELDS if not f.late)
