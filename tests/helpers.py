"""Small frames for unit tests."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime

from casewright import contracts as C


def ts(text: str | None):
    return None if text is None else datetime.fromisoformat(text)


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, *columns):
    """Rows as a sorted list of tuples (single values when one column is given)."""
    picked = [tuple(r) for r in df.select(*columns).collect()]
    if len(columns) == 1:
        picked = [r[0] for r in picked]
    return sorted(picked, key=repr)


def bag(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(repr(v) for v in row) for row in df.select(*names).collect())


def complaint(**changes) -> dict:
    """A valid complaint in wire form; ``None`` stays null, ``...`` drops the key."""
    record = {f.wire: "x" for f in C.COMPLAINT_FIELDS}
    record |= {
        "ticketNumber": "T1", "officeNAme": "Collector", "govtTicket": "Yes",
        "CreatedOn": "2025-01-02T03:04:05", "assignedOn": "2025-01-03T00:00:00",
        "taggedDate": None, "escalationDate": None, "ResolvedOn": None, "benefitted": None,
        "Document": "http://example.org/file~pdf",
    }
    record |= changes
    return {k: v for k, v in record.items() if v is not ...}


def envelope(*records, key="Res", status=200) -> str:
    return json.dumps({"status": status, "message": "m", key: list(records)})


def tickets(spark, rows: list[dict]):
    """Analysis rows with defaults for the columns a test does not mention."""
    schema = (
        "ticket_no string, office string, district string, mode string, status_id int, category string, "
        "dept string, subcategory string, complaint_text string, petitioner_mobile string, benefitted string, "
        "created_on timestamp_ntz, resolved_on timestamp_ntz, escalation_date timestamp_ntz"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    data = []
    for i, row in enumerate(rows):
        full = {"ticket_no": f"T{i}", "office": "A", "mode": "Website", "status_id": 2,
                "created_on": "2025-01-01", **row}
        data.append(tuple(
            ts(full.get(n)) if n.endswith(("_on", "_date")) else full.get(n) for n in names
        ))
    return spark.createDataFrame(data, schema)


def plans_sorted(rows) -> str:
    """The static plan as text where small test tables are not broadcast."""
    conf = rows.sparkSession.conf
    held = {n: conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return rows.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in held.items():
            conf.set(n, v)
