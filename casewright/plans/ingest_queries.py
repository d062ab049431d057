"""Source, conformance and constraint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.functions import dates
from casewright.operators import actions as action_ops, conform, quality
from casewright.plans import fixtures as fx
from casewright.plans.registry import query, with_ctes
from casewright.plans.report_queries import STACKED_SQL, _FEED_TICKETS, t
from casewright.sources import column_json, landing, ticket_lists

A = fx.actions_sql()
FAULTY = " OR ".join(fx.RECORD_FAULTS.values())
OK = fx.ENVELOPE_OK


def unwrapped(spark, sf):
    return landing.unwrap_envelopes(fx.payloads(spark, sf))


# --- sources -----------------------------------------------------------------------------


@query("s1_unwrapped_records", with_ctes(t("seq", "ticket_no"),
       f"SELECT seq, 0 AS pos, ticket_no FROM tickets WHERE {OK}"))
def _(spark, sf):
    return unwrapped(spark, sf).records.select(
        "seq", "pos", F.variant_get("record", "$.ticketNumber", "string").alias("ticket_no")
    )


@query("s1_rejected_envelopes", with_ctes(t("seq"), """
 SELECT seq, CASE WHEN seq % 29 = 0 THEN 'error_status' ELSE 'no_payload' END AS reason
 FROM tickets WHERE seq % 29 = 0 OR (seq % 31 <> 0 AND seq % 37 = 0)"""))
def _(spark, sf):
    return unwrapped(spark, sf).rejects.select("seq", "reason")


@query("s2_districts", "SELECT n_nationkey AS dist_id, n_name AS dist_name FROM nation WHERE n_nationkey % 4 <> 3")
def _(spark, sf):
    """District envelopes; every fourth id is spelled as a fraction and rejected."""
    rows = fx.districts(spark, sf)
    dist_id = F.when(F.col("dist_id") % 4 == 3, F.concat(F.col("dist_id"), F.lit(".5"))).otherwise(
        F.col("dist_id").cast("string")
    )
    record = F.to_json(F.struct(dist_id.alias("distId"), F.col("dist_name").alias("distName")))
    envelopes = rows.select(
        F.concat(F.lit('{"status":200,"distRes":['), record, F.lit("]}")).alias("value")
    )
    return conform.conform_districts(landing.unwrap_envelopes(envelopes).records.drop("pos")).valid


_CELL = ("ticket_no", "year", "dist_id", "status_id", "office_code")


@query("s3_cell_records", with_ctes(t(*_CELL), """
 SELECT ticket_no, year, dist_id, status_id AS status, office_code AS office FROM tickets
 WHERE office_code <> 5"""))
def _(spark, sf):
    """Records with the fetch cell carried along; cells outside the code domain are dropped.
    The fifth region is given an unknown office code."""
    rows = fx.tickets(spark, sf, *_CELL).select(
        F.concat(F.lit('{"status":200,"Res":['),
                 F.to_json(F.struct(F.col("ticket_no").alias("ticketNumber"))), F.lit("]}")).alias("value"),
        "year", "dist_id", F.col("status_id").alias("status"),
        F.when(F.col("office_code") == 5, F.lit(9)).otherwise(F.col("office_code")).alias("office"),
    )
    known = rows.where(F.col("status").isin(*C.STATUSES) & F.col("office").isin(*C.OFFICES))
    return landing.unwrap_envelopes(known).records.select(
        F.variant_get("record", "$.ticketNumber", "string").alias("ticket_no"), *C.CELL_KEYS
    )


@query("s4_action_records", with_ctes(A, "SELECT seq, ticket_no, action_status FROM actions"))
def _(spark, sf):
    """Each record takes the ticket its request asked for."""
    records = landing.unwrap_envelopes(fx.action_payloads(spark, sf)).records
    return records.select(
        "seq", F.col("request_ticket").alias("ticket_no"),
        F.variant_get("record", "$.action_status", "string").alias("action_status"),
    )


@query("s5_column_oriented_rows", with_ctes(t("ticket_no", "mode", "created_on", "govt_ticket"), """
 SELECT ticket_no AS file, '0' AS row_id, mode, created_on, govt_ticket FROM tickets"""))
def _(spark, sf):
    """One column-oriented document per ticket, read back as rows."""
    millis = F.timestamp_diff("MILLISECOND", dates.ntz("1970-01-01"), F.col("created_on"))
    documents = fx.tickets(spark, sf, "ticket_no", "mode", "created_on", "govt_ticket").select(
        F.col("ticket_no").alias("file"),
        F.to_json(F.struct(
            F.struct(F.col("mode").alias("0")).alias("mode"),
            F.struct(millis.alias("0")).alias("created_on"),
            F.struct(F.col("govt_ticket").alias("0")).alias("govt_ticket"),
        )).alias("text"),
    )
    return column_json.rows_of(
        documents, ["mode", "created_on", "govt_ticket"], ["created_on"], ["govt_ticket"]
    )


@query("s8_ticket_list", with_ctes(t("ticket_no", "office", "benefitted"), """
 SELECT ticket_no FROM tickets WHERE office = 'Chief Secretary' AND benefitted = 'Yes'"""))
def _(spark, sf):
    documents = fx.tickets(spark, sf, "ticket_no", "office", "benefitted").select(
        F.to_json(F.create_map(
            "office", F.create_map(F.coalesce("benefitted", F.lit("")), F.array("ticket_no"))
        )).alias("doc")
    )
    return ticket_lists.ticket_list(
        ticket_lists.expand_ticket_lists(documents, "doc"), "Chief Secretary", "Yes"
    )


@query("s8_first_tickets_of_list", with_ctes(t("ticket_no", "office", "benefitted"), """
 SELECT ticket_no FROM tickets WHERE office = 'Office of Chief Minister' AND benefitted = 'Yes'
 ORDER BY ticket_no LIMIT 100"""))
def _(spark, sf):
    lists = fx.tickets(spark, sf, "ticket_no", "office", "benefitted").withColumnRenamed("benefitted", "flag")
    return ticket_lists.ticket_list(lists, "Office of Chief Minister", "Yes", first=100)


@query("s9_stacked_batches", with_ctes(_FEED_TICKETS, STACKED_SQL, """
 SELECT ticket_no, created_on, resolved_on FROM stacked"""))
def _(spark, sf):
    return landing.union_batches(
        *fx.feeds(spark, sf, "ticket_no", "created_on", "resolved_on").values()
    )


@query("s11_actions_of_listed_tickets", with_ctes(A, t("ticket_no", "benefitted"), """
 SELECT seq, ticket_no, action_status FROM actions
 WHERE ticket_no IN (SELECT ticket_no FROM tickets WHERE benefitted = 'Yes')"""))
def _(spark, sf):
    listed = fx.tickets(spark, sf, "ticket_no", "benefitted").where("benefitted = 'Yes'")
    return action_ops.actions_for(fx.actions(spark, sf, "seq", "ticket_no", "action_status"), listed)


# --- conformance ------------------------------------------------------------------------------


@query("v1_v8_valid_complaints", with_ctes(t(*fx.RECORD_COLUMNS, "seq"), f"""
 SELECT * REPLACE (created_on + INTERVAL '2' DAY AS assigned_on)
 FROM tickets WHERE {OK} AND NOT ({FAULTY})"""))
def _(spark, sf):
    return conform.conform_complaints(unwrapped(spark, sf).records.drop("pos")).valid


@query("v8_rejected_complaints", with_ctes(t("seq", "document_url"), " UNION ALL ".join(
    f"SELECT seq, 0 AS pos, '{error}' AS error FROM tickets WHERE {OK} AND ({where})"
    for error, where in fx.RECORD_FAULTS.items())))
def _(spark, sf):
    rejects = conform.conform_complaints(unwrapped(spark, sf).records).rejects
    return rejects.select("seq", "pos", F.explode("errors").alias("error"))


@query("v4_office_spellings", with_ctes(t("office", "seq"), """
 spelled AS (SELECT office, CASE WHEN seq % 5 = 0 THEN 'Dept' WHEN seq % 5 = 1 THEN 'Unknown Office'
  WHEN seq % 5 = 2 THEN replace(replace(office, 'Chief', 'Cheif'), 'Superintendent', 'Supertendent')
  WHEN seq % 5 = 3 THEN upper(office) ELSE office END AS spelling FROM tickets)""", """
 SELECT spelling, CASE WHEN spelling IN ('Dept', 'Unknown Office') THEN NULL
  WHEN spelling = upper(spelling) AND office <> 'DG & IG Police' THEN NULL ELSE office END AS matched, count(*) AS count
 FROM spelled GROUP BY 1, 2"""))
def _(spark, sf):
    seq = F.col("seq") % 5
    spelling = (
        F.when(seq == 0, F.lit("Dept")).when(seq == 1, F.lit("Unknown Office"))
        .when(seq == 2, F.replace(F.replace("office", F.lit("Chief"), F.lit("Cheif")),
                                  F.lit("Superintendent"), F.lit("Supertendent")))
        .when(seq == 3, F.upper("office")).otherwise(F.col("office"))
    )
    rows = fx.tickets(spark, sf, "office", "seq").select(spelling.alias("spelling"))
    return rows.groupBy("spelling").agg(F.count("*").alias("count")).select(
        "spelling", conform.matched_office(F.col("spelling")).alias("matched"), "count"
    )


# Spelling by key modulo 16 and what it stands for.
_ISO_FORMS = {
    0: ("yyyy-MM-dd", "date_trunc('day', created_on)"), 1: ("yyyy-MM-dd'T'HH:mm:ss", "created_on"),
    2: ("yyyy-MM-dd HH:mm:ss'.250'", "created_on + INTERVAL '250' MILLISECOND"),
    3: ("yyyy-MM-dd'T'HH:mm:ss'+05:30'", "created_on - INTERVAL '330' MINUTE"),
    4: ("yyyy-MM-dd'T'HH:mm:ss'Z'", "created_on"), 5: ("yyyyMMdd", "date_trunc('day', created_on)"),
    6: ("yyyy-M-d'T'H:m:s", "created_on"), 7: ("yyyy", "NULL"),
    8: ("yyyy-MM-dd'T'HH:mm'Z'", "date_trunc('minute', created_on)"), 9: ("yyyyMMdd'T'HHmmss", "created_on"),
    10: ("yyyy-MM-dd'T'HHmmss", "created_on"), 11: ("yyyy-MM-dd'T'HH:mm:ss'+05'", "created_on - INTERVAL '5' HOUR"),
    12: ("yyyyMMdd HHmm", "date_trunc('minute', created_on)"), 13: ("yyyy-MM-dd'_'HH", "date_trunc('hour', created_on)"),
    14: ("yyyy-MM-dd'T'HH:mm:ss',5-0330'", "created_on + INTERVAL '210' MINUTE + INTERVAL '500' MILLISECOND"),
    15: ("yyyy-MM-dd'T'HH:mm:ss'+25:00'", "NULL"),
}


@query("v6_iso_times", with_ctes(t("seq", "created_on"), "SELECT seq, CASE seq % 16 "
       + " ".join(f"WHEN {k} THEN {sql}" for k, (_, sql) in _ISO_FORMS.items()) + " END::TIMESTAMP AS parsed FROM tickets"))
def _(spark, sf):
    spelled = F
    for kind, (pattern, _) in _ISO_FORMS.items():
        spelled = spelled.when(F.col("seq") % 16 == kind, F.date_format("created_on", pattern))
    return fx.tickets(spark, sf, "seq", "created_on").select(
        "seq", dates.parse_iso(spelled.otherwise(None)).alias("parsed")
    )


@query("v7_action_times", """
 SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS plain_24h,
  (date_trunc('minute', ts) - CASE WHEN hour(ts) >= 13 THEN INTERVAL '12' HOUR WHEN hour(ts) = 0 THEN INTERVAL '-12' HOUR
   ELSE INTERVAL '0' HOUR END)::TIMESTAMP AS ignored_mark, date_trunc('minute', ts)::TIMESTAMP AS honoured_mark,
  CAST(NULL AS TIMESTAMP) AS unreadable
 FROM events""")
def _(spark, sf):
    def spelled(pattern):
        return F.date_format("ts", pattern)

    return fx.read(spark, sf, "events").select(
        "event_id",
        dates.parse_action_time(spelled("dd-MMM-yyyy HH:mm a")).alias("plain_24h"),
        dates.parse_action_time(spelled("dd-MMM-yyyy hh:mm a")).alias("ignored_mark"),
        dates.parse_action_time(spelled("dd-MMM-yyyy hh:mm a"), fix_meridiem=True).alias("honoured_mark"),
        dates.parse_action_time(spelled("MMM dd yyyy")).alias("unreadable"),
    )


@query("v9_valid_actions", with_ctes(A, """
 SELECT seq, ticket_no, action_taken_by,
  (CASE seq % 3 WHEN 0 THEN date_trunc('second', action_taken_date) WHEN 1 THEN date_trunc('minute', action_taken_date) END)::TIMESTAMP
   AS action_taken_date,
  action_taken_remark, action_status, complaint_status_with_authority
 FROM actions WHERE action_status <> 'Complaint Assigned'"""))
def _(spark, sf):
    records = landing.unwrap_envelopes(fx.action_payloads(spark, sf)).records.drop("pos")
    return conform.conform_actions(records).valid


# --- constraints ----------------------------------------------------------------------------------

_REQUIRED = C.REQUIRED_COLUMNS["complaints"]


@query("v10_null_violations", with_ctes(t(*_REQUIRED), " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS violations FROM tickets" for c in _REQUIRED)))
def _(spark, sf):
    return quality.null_violations(fx.tickets(spark, sf, *_REQUIRED), _REQUIRED)


@query("v11_repeated_action_keys", with_ctes(A, f"""
 SELECT {', '.join(C.ACTION_KEY)}, count(*) AS row_count FROM actions
 GROUP BY {', '.join(C.ACTION_KEY)} HAVING count(*) > 1"""))
def _(spark, sf):
    return quality.unique_violations(fx.actions(spark, sf), C.ACTION_KEY)


@query("v12_orphan_actions", with_ctes(A, t("ticket_no", "created_on"), f"""
 SELECT ticket_no, count(*) AS row_count FROM actions
 WHERE ticket_no NOT IN (SELECT ticket_no FROM tickets WHERE {fx.EXISTING}) GROUP BY ticket_no"""))
def _(spark, sf):
    stored = fx.tickets(spark, sf, "ticket_no", "created_on").where(fx.EXISTING)
    return quality.orphans(fx.actions(spark, sf, "ticket_no"), stored, "ticket_no")


@query("v13_code_domain", with_ctes(t("ticket_no", "status_id", "dist_id"), """
 SELECT ticket_no, status_id AS status, dist_id AS office FROM tickets
 WHERE NOT coalesce(status_id IN (0, 1, 2) AND dist_id BETWEEN 1 AND 7, false)"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "status_id", "dist_id").withColumnsRenamed(
        {"status_id": "status", "dist_id": "office"}
    )
    return quality.domain_violations(rows)


@query("v14_defaults", with_ctes(t("ticket_no", "document_downloaded"), """
 SELECT ticket_no, coalesce(document_downloaded, false) AS document_downloaded, 0 AS failure_count FROM tickets"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "document_downloaded")
    return quality.with_defaults(rows, {**quality.COMPLAINT_DEFAULTS, **quality.TRACKING_DEFAULTS})
