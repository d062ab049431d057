"""Lookup, merge, tracking and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.functions import dates
from casewright.operators import documents, lookup, merge, reports, tracking
from casewright.plans import fixtures as fx
from casewright.plans.registry import query, with_ctes
from casewright.plans.report_queries import CHANNEL_SQL, t
from casewright.session import run_folder
from casewright.sources.tables import store_bucketed

A = fx.actions_sql()
DOC = C.DOCUMENT_COLUMNS

# --- lookups -----------------------------------------------------------------------------

_DISTRICTS = "districts AS (SELECT n_nationkey AS dist_id, n_name AS dist_name FROM nation)"


@query("l1_district_by_id", with_ctes(_DISTRICTS, "SELECT * FROM districts WHERE dist_id = 7"))
def _(spark, sf):
    return lookup.district_by_id(fx.districts(spark, sf), 7)


@query("l2_district_by_name", with_ctes(_DISTRICTS, "SELECT * FROM districts WHERE dist_name = 'NATION_3'"))
def _(spark, sf):
    return lookup.district_by_name(fx.districts(spark, sf), "NATION_3")


@query("l3_all_districts", with_ctes(_DISTRICTS, "SELECT * FROM districts"))
def _(spark, sf):
    return fx.districts(spark, sf)


@query("l4_all_complaints", with_ctes(t(*C.COMPLAINT_SCHEMA.fieldNames()), "SELECT * FROM tickets"))
def _(spark, sf):
    return fx.complaint_table(spark, sf)


_SHORT = ("ticket_no", "district", "status", "mode")


@query("l5_complaint_by_ticket", with_ctes(t(*_SHORT), "SELECT * FROM tickets WHERE ticket_no = 'T42'"))
def _(spark, sf):
    return lookup.complaint_by_ticket(fx.tickets(spark, sf, *_SHORT), "T42")


@query("l6_complaints_by_district", with_ctes(t(*_SHORT), "SELECT * FROM tickets WHERE district = 'NATION_3'"))
def _(spark, sf):
    return lookup.complaints_by_district(fx.tickets(spark, sf, *_SHORT), "NATION_3")


@query("l7_complaints_by_status", with_ctes(t(*_SHORT), "SELECT * FROM tickets WHERE status = 'Disposed'"))
def _(spark, sf):
    return lookup.complaints_by_status(fx.tickets(spark, sf, *_SHORT), "Disposed")


@query("l8_actions_by_ticket", with_ctes(A, "SELECT * FROM actions WHERE ticket_no = 'T11'"))
def _(spark, sf):
    return lookup.actions_by_ticket(fx.actions(spark, sf), "T11")


_DOCS = ("ticket_no", "document_url", *DOC)
_NO_DOC = "document_url NOT IN ('', 'N/A') AND document_downloaded = false"


@query("l9_without_documents", with_ctes(t(*_DOCS),
       f"SELECT * FROM tickets WHERE {_NO_DOC} AND document_download_error IS NULL"))
def _(spark, sf):
    return lookup.without_documents(fx.tickets(spark, sf, *_DOCS))


@query("l9_without_documents_after_errors", with_ctes(t(*_DOCS),
       f"SELECT * FROM tickets WHERE {_NO_DOC} AND document_download_error IS NOT NULL"))
def _(spark, sf):
    return lookup.without_documents(fx.tickets(spark, sf, *_DOCS), failed_before=True)


@query("l10_with_document_urls", with_ctes(t("ticket_no", "document_url"),
       "SELECT * FROM tickets WHERE document_url IS DISTINCT FROM ''"))
def _(spark, sf):
    return lookup.with_document_urls(fx.tickets(spark, sf, "ticket_no", "document_url"))


@query("l11_existing_in_batch", with_ctes(t("ticket_no", "status", "status_id", "created_on"), f"""
 SELECT ticket_no, status FROM tickets WHERE {fx.EXISTING} AND {fx.INCOMING}"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "status", "status_id", "created_on")
    batch = fx.complaint_batch(spark, sf, "ticket_no")
    return lookup.existing_in_batch(rows.where(fx.EXISTING).select("ticket_no", "status"), batch, "ticket_no")


_FILTERED = ("ticket_no", "mode", "office", "status_id", "benefitted", "complaint_text")


@query("l12_analytic_filter", with_ctes(t(*_FILTERED), f"""
 SELECT ticket_no FROM tickets WHERE {CHANNEL_SQL['online']} AND office = 'Collector' AND status_id = 2
 AND benefitted = 'No' AND NOT contains(complaint_text, 'Ration Card') AND contains(complaint_text, 'e')"""))
def _(spark, sf):
    return lookup.tickets_where(
        fx.tickets(spark, sf, *_FILTERED), modes=C.CHANNEL_MODES["online"], office="Collector",
        status_id=2, benefitted="No", contains_none=["Ration Card"], contains=["e"],
    ).select("ticket_no")


@query("l13_renamed_columns", with_ctes(t("ticket_no", "mode", "status"), """
 SELECT ticket_no, mode AS avg_channel, status AS avg_status FROM tickets"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "mode", "status")
    return lookup.renamed(rows, {"mode": "channel"}, prefix="avg_", keep=("ticket_no",))


@query("l14_corrected_office", with_ctes(t("ticket_no", "office"), """
 SELECT ticket_no, office FROM tickets"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "office").withColumn(
        "office", F.replace("office", F.lit("Superintendent"), F.lit("Supertendent"))
    )
    return rows.withColumn("office", reports.tx.corrected_office("office"))


@query("l15_recoded_modes", with_ctes(t("ticket_no", "mode"), f"""
 SELECT ticket_no, CASE WHEN {CHANNEL_SQL['online']} THEN 'online' WHEN {CHANNEL_SQL['offline']} THEN 'offline'
  WHEN {CHANNEL_SQL['freetext']} THEN 'freetext' ELSE 'unknown' END AS channel FROM tickets"""))
def _(spark, sf):
    return fx.tickets(spark, sf, "ticket_no", "mode").select(
        "ticket_no", reports.tx.channel_of("mode", "unknown").alias("channel")
    )


@query("l16_open_days", with_ctes(t("ticket_no", "created_on", "resolved_on"), f"""
 SELECT ticket_no, CAST(floor((epoch_us(coalesce(resolved_on, TIMESTAMP '{fx.AS_OF}')) - epoch_us(created_on))
  / 86400000000.0) AS BIGINT) AS days_open FROM tickets"""))
def _(spark, sf):
    return fx.tickets(spark, sf, "ticket_no", "created_on", "resolved_on").select(
        "ticket_no", F.when(
            F.col("resolved_on").isNotNull(), dates.elapsed_days("created_on", "resolved_on")
        ).otherwise(dates.elapsed_days("created_on", dates.ntz(fx.AS_OF))).alias("days_open"),
    )


# --- district merges ---------------------------------------------------------------------------

_STORED_DISTRICTS = """stored AS (SELECT n_nationkey AS dist_id, n_name AS dist_name FROM nation WHERE n_regionkey < 3),
 batch AS (SELECT n_nationkey AS dist_id, n_name || ' ' || c_mktsegment AS dist_name, c_custkey AS ingest_seq
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
 latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY dist_id ORDER BY ingest_seq DESC) = 1)"""


def _districts_sql(renames: bool) -> str:
    name = "coalesce(l.dist_name, s.dist_name)" if renames else "coalesce(s.dist_name, l.dist_name)"
    matched = "CASE WHEN s.dist_name = l.dist_name THEN 'noop' ELSE 'update' END" if renames else "'noop'"
    return with_ctes(_STORED_DISTRICTS, f"""
 SELECT coalesce(s.dist_id, l.dist_id) AS dist_id, {name} AS dist_name,
  CASE WHEN l.dist_id IS NULL THEN 'kept' WHEN s.dist_id IS NULL THEN 'insert' ELSE {matched} END AS action
 FROM stored s FULL JOIN latest l ON s.dist_id = l.dist_id""")


@query("m1_m4_merge_districts", _districts_sql(True))
def _(spark, sf):
    return merge.merge_districts(fx.stored_districts(spark, sf), fx.district_batch(spark, sf))


@query("m7_load_districts", _districts_sql(True))
def _(spark, sf):
    """The batch repeats unseen ids, so names are refreshed too."""
    return merge.load_districts(fx.stored_districts(spark, sf), fx.district_batch(spark, sf))


@query("m7_load_districts_insert_only", _districts_sql(False))
def _(spark, sf):
    return merge.load_districts(
        fx.stored_districts(spark, sf), fx.district_batch(spark, sf), rename="never"
    )


# --- complaint merges ------------------------------------------------------------------------------

_MERGED = ("ticket_no", "status", "category", "district", "created_on", "resolved_on", "benefitted",
           "document_downloaded", "local_document_path")
_MERGE_CTES = (t(*_MERGED, "status_id"), f"""
 e AS (SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS resolved_on, CAST(NULL AS VARCHAR) AS benefitted)
  FROM tickets WHERE {fx.EXISTING})""", f"i AS (SELECT * FROM tickets WHERE {fx.INCOMING})")
_MERGE_ACTION = """CASE WHEN i.ticket_no IS NULL THEN 'kept' WHEN e.ticket_no IS NULL THEN 'insert'
 WHEN (e.status, e.category, e.district, e.created_on, e.resolved_on, e.benefitted) IS NOT DISTINCT FROM
  (i.status, i.category, i.district, i.created_on, i.resolved_on, i.benefitted) THEN 'noop' ELSE 'update' END"""


def _merged_sql(where: str) -> str:
    def pick(c: str) -> str:
        return f"CASE WHEN i.ticket_no IS NOT NULL THEN i.{c} ELSE e.{c} END AS {c}"
    fields = ("status", "category", "district", "created_on", "resolved_on", "benefitted")
    return with_ctes(*_MERGE_CTES, f"""
 SELECT * FROM (SELECT coalesce(e.ticket_no, i.ticket_no) AS ticket_no, {', '.join(pick(c) for c in fields)},
  CASE WHEN e.ticket_no IS NULL THEN false ELSE e.document_downloaded END AS document_downloaded,
  e.local_document_path AS local_document_path, {_MERGE_ACTION} AS action
 FROM e FULL JOIN i ON e.ticket_no = i.ticket_no) WHERE {where}""")


def _complaint_sides(spark, sf):
    return fx.stored_complaints(spark, sf), fx.complaint_batch(spark, sf)


@query("m2_m5_merge_complaints", _merged_sql("TRUE"))
def _(spark, sf):
    return merge.merge_complaints(*_complaint_sides(spark, sf)).select(*_MERGED, "action")


@query("m8_changed_complaints", _merged_sql("action IN ('insert', 'update')"))
def _(spark, sf):
    return merge.changed_complaints(*_complaint_sides(spark, sf)).select(*_MERGED, "action")


@query("m8_merge_into_buckets", _merged_sql("TRUE"))
def _(spark, sf):
    """The stored complaints bucketed by ticket: only the batch is shuffled."""
    existing, batch = _complaint_sides(spark, sf)
    stored = store_bucketed(existing, run_folder(spark, "complaints"), ["ticket_no"])
    return merge.merge_complaints(stored, batch).select(*_MERGED, "action")


# --- action merges ----------------------------------------------------------------------------------

_KEY = ", ".join(C.ACTION_KEY)
_CUT = "TIMESTAMP '2024-01-16 00:00:00'"
_DATE = """CASE action_status WHEN 'Reminder Sent' THEN NULL
 WHEN 'Complaint Register' THEN date_trunc('day', action_taken_date) ELSE action_taken_date END"""
_SEEN = "CASE WHEN action_status = 'Forward' THEN action_taken_remark || ' seen' ELSE action_taken_remark END"
_ACTION_CTES = (A, f"""dated AS (SELECT * REPLACE ({_DATE} AS action_taken_date), action_taken_date < {_CUT} AS old
 FROM actions)""", f"""ex AS (SELECT {_KEY}, action_taken_date FROM dated WHERE old
 QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY seq) = 1)""", f"""
 bt AS (SELECT {_KEY}, action_taken_date FROM (SELECT * REPLACE ({_SEEN} AS action_taken_remark) FROM dated)
 QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY seq) = 1)""", f"""
 nw AS (SELECT * FROM bt ANTI JOIN ex USING ({_KEY}))""")


def _action_tables(spark, sf):
    dated = fx.actions(spark, sf).withColumns({
        "old": F.expr(f"action_taken_date < {_CUT}"), "action_taken_date": F.expr(f"CAST({_DATE} AS TIMESTAMP_NTZ)"),
    })
    stored = merge.first_in_batch(dated.where("old"), C.ACTION_KEY, "seq").select(*C.ACTION_SCHEMA.fieldNames())
    batch = dated.withColumn("action_taken_remark", F.expr(_SEEN)).withColumnRenamed("seq", "ingest_seq")
    return stored, batch


@query("m3_m6_append_actions", with_ctes(*_ACTION_CTES, """
 SELECT *, 'kept' AS action FROM ex UNION ALL BY NAME SELECT *, 'insert' AS action FROM nw"""))
def _(spark, sf):
    return merge.append_actions(*_action_tables(spark, sf))


@query("m9_load_actions", with_ctes(*_ACTION_CTES, """
 slots AS (SELECT ticket_no, action_taken_date FROM nw WHERE action_taken_date IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1
  INTERSECT SELECT ticket_no, action_taken_date FROM ex WHERE action_taken_date IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1)""", """
 SELECT *, 'kept' AS action FROM ex ANTI JOIN slots USING (ticket_no, action_taken_date) UNION ALL BY NAME
 SELECT nw.*, CASE WHEN slots.ticket_no IS NULL THEN 'insert' ELSE 'update' END AS action
 FROM nw LEFT JOIN slots ON nw.ticket_no = slots.ticket_no AND nw.action_taken_date = slots.action_taken_date"""))
def _(spark, sf):
    return merge.load_actions(*_action_tables(spark, sf))


# --- document outcome merges ----------------------------------------------------------------------------

_NOW = f"TIMESTAMP '{fx.NOW}'"


@query("m10_update_document_status", with_ctes(t("ticket_no", *DOC), f"""
 SELECT ticket_no, CASE WHEN ticket_no = 'T42' THEN NULL ELSE local_document_path END AS local_document_path,
  CASE WHEN ticket_no = 'T42' THEN false ELSE document_downloaded END AS document_downloaded,
  CASE WHEN ticket_no = 'T42' THEN {_NOW} ELSE document_download_date END AS document_download_date,
  CASE WHEN ticket_no = 'T42' THEN 'gone' ELSE document_download_error END AS document_download_error
 FROM tickets"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", *DOC)
    return documents.update_status(rows, "T42", None, False, fx.NOW, "gone")


def _apply_updates_sql(update_filter: str, dated: str) -> str:
    return with_ctes(t("ticket_no", *DOC), fx.ATTEMPTS_SQL, f"""
 u AS (SELECT * FROM (SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY ticket_no ORDER BY attempt_seq) = 1)
  WHERE {update_filter})""", f"""
 SELECT t.ticket_no,
  CASE WHEN u.ticket_no IS NULL THEN local_document_path WHEN error IS NULL THEN local_path END AS local_document_path,
  CASE WHEN u.ticket_no IS NULL THEN document_downloaded ELSE local_path IS NOT NULL END AS document_downloaded,
  CASE WHEN u.ticket_no IS NOT NULL AND {dated} THEN {_NOW} ELSE document_download_date END AS document_download_date,
  CASE WHEN u.ticket_no IS NULL THEN document_download_error ELSE error END AS document_download_error
 FROM tickets t LEFT JOIN u ON t.ticket_no = u.ticket_no""")


def _updates(spark, sf):
    return (
        fx.tickets(spark, sf, "ticket_no", *DOC),
        documents.updates_from_attempts(fx.attempts(spark, sf)),
    )


@query("m11_apply_document_updates", _apply_updates_sql("TRUE", "local_path IS NOT NULL"))
def _(spark, sf):
    return documents.apply_updates(*_updates(spark, sf), fx.NOW)


@query("m11_updates_into_buckets", _apply_updates_sql("TRUE", "local_path IS NOT NULL"))
def _(spark, sf):
    """The stored complaints bucketed by ticket: only the updates are shuffled."""
    complaints, updates = _updates(spark, sf)
    return documents.apply_updates(store_bucketed(complaints, run_folder(spark, "complaints"), ["ticket_no"]), updates, fx.NOW)


@query("m11_apply_updates_skips_untouched", _apply_updates_sql(
    "local_path IS NOT NULL OR error IS NOT NULL", "local_path IS NOT NULL"))
def _(spark, sf):
    return documents.apply_updates(*_updates(spark, sf), fx.NOW, skip_clears=False)


# --- tracking ---------------------------------------------------------------------------------------------

_CELLS = ("year", "dist_id", "status_id", "office_code", "created_on", "mode", "priority", "seq")
_CELL_CTES = (t(*_CELLS), fx.CELL_TRACKING_SQL)
_TRACKED = "last_successful_fetch, records_count, failure_count"
_OUTCOMES = """outcomes AS (SELECT year, dist_id, status_id AS status, 8 - office_code AS office,
 CASE WHEN priority = '5-LOW' THEN 'failure' ELSE 'success' END AS outcome, seq % 100 AS records, seq AS attempt_seq
 FROM tickets)"""


def _outcomes(spark, sf):
    """One attempt per ticket on a cell; half of the cells are not tracked yet."""
    return fx.tickets(spark, sf, *_CELLS).select(
        "year", "dist_id", F.col("status_id").alias("status"), (8 - F.col("office_code")).alias("office"),
        F.expr("CASE WHEN priority = '5-LOW' THEN 'failure' ELSE 'success' END").alias("outcome"),
        (F.col("seq") % 100).alias("records"), F.col("seq").alias("attempt_seq"),
    )


_FOLDED = """folded AS (SELECT year, dist_id, status, office,
  max(attempt_seq) FILTER (outcome = 'success') AS won, arg_max(records, attempt_seq) FILTER (outcome = 'success') AS records,
  list(attempt_seq) FILTER (outcome = 'failure') AS lost FROM outcomes GROUP BY 1, 2, 3, 4)"""


@query("t1_t3_record_cell_outcomes", with_ctes(*_CELL_CTES, _OUTCOMES, _FOLDED, f"""
 SELECT coalesce(c.year, f.year) AS year, coalesce(c.dist_id, f.dist_id) AS dist_id,
  coalesce(c.status, f.status) AS status, coalesce(c.office, f.office) AS office,
  CASE WHEN won IS NOT NULL THEN {_NOW} ELSE last_successful_fetch END AS last_successful_fetch,
  CASE WHEN won IS NOT NULL THEN records ELSE records_count END AS records_count,
  CASE WHEN won IS NOT NULL THEN 0 ELSE coalesce(failure_count, 0) END
   + coalesce(len(list_filter(lost, lambda x: won IS NULL OR x > won)), 0) AS failure_count
 FROM cells c FULL JOIN folded f ON c.year = f.year AND c.dist_id = f.dist_id AND c.status = f.status AND c.office = f.office"""))
def _(spark, sf):
    return tracking.record_outcomes(
        fx.cell_tracking(spark, sf), _outcomes(spark, sf), tracking.CELL_KEYS, fx.NOW
    )


_GRID = """grid AS (SELECT y AS year, n_nationkey AS dist_id, s AS status, o AS office FROM nation,
 (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001), (2002)) v1(y), (VALUES (0), (1), (2)) v2(s),
 (VALUES (1), (2), (3), (4), (5), (6), (7)) v3(o))"""
_YEARS = tuple(range(1995, 2003))


def _to_fetch_sql(days: int, failures: int) -> str:
    return f"""due AS (SELECT year, dist_id, status, office FROM grid LEFT JOIN cells USING (year, dist_id, status, office)
 WHERE NOT coalesce(last_successful_fetch >= {_NOW} - INTERVAL '{days}' DAY, false)
 AND NOT coalesce(failure_count >= {failures}, false))"""


def _grid(spark, sf):
    return tracking.request_grid(fx.districts(spark, sf), _YEARS)


@query("t7_request_grid", with_ctes(_GRID, "SELECT * FROM grid"))
def _(spark, sf):
    return _grid(spark, sf)


@query("t2_cells_to_fetch", with_ctes(*_CELL_CTES, _GRID, _to_fetch_sql(400, 3), "SELECT * FROM due"))
def _(spark, sf):
    return tracking.cells_to_fetch(_grid(spark, sf), fx.cell_tracking(spark, sf), fx.NOW, 400, 3)


@query("t8_with_forced_cells", with_ctes(*_CELL_CTES, _GRID, _to_fetch_sql(7, 1), """
 SELECT * FROM due UNION ALL SELECT year, dist_id, status, office FROM cells WHERE failure_count > 1"""))
def _(spark, sf):
    cells = fx.cell_tracking(spark, sf)
    due = tracking.cells_to_fetch(_grid(spark, sf), cells, fx.NOW, 7, 1)
    return tracking.with_forced_cells(due, cells.where("failure_count > 1"))


@query("t4_record_ticket_success", with_ctes(fx.TICKET_TRACKING_SQL, """
 brought AS (SELECT 'T' || CAST(o_custkey AS STRING) AS ticket_no, count(*) AS records FROM orders GROUP BY 1)""", f"""
 SELECT coalesce(t.ticket_no, b.ticket_no) AS ticket_no,
  CASE WHEN b.ticket_no IS NOT NULL THEN TIMESTAMP '{fx.EVENTS_NOW}' ELSE last_successful_fetch END AS last_successful_fetch,
  coalesce(records, records_count) AS records_count,
  CASE WHEN b.ticket_no IS NOT NULL THEN 0 ELSE failure_count END AS failure_count
 FROM tracking t FULL JOIN brought b ON t.ticket_no = b.ticket_no"""))
def _(spark, sf):
    successes = fx.tickets(spark, sf, "custkey").groupBy(
        F.expr("'T' || CAST(custkey AS STRING)").alias("ticket_no")
    ).agg(F.count("*").alias("records"))
    return tracking.record_successes(
        fx.ticket_tracking(spark, sf), successes, tracking.TICKET_KEYS, fx.EVENTS_NOW
    )


@query("t5_record_ticket_failures", with_ctes(fx.TICKET_TRACKING_SQL, """
 failed AS (SELECT 'T' || CAST(o_custkey AS STRING) AS ticket_no, count(*) AS n FROM orders
  WHERE o_orderstatus = 'P' GROUP BY 1)""", f"""
 SELECT coalesce(t.ticket_no, f.ticket_no) AS ticket_no, {_TRACKED.replace('failure_count', '')}
  coalesce(failure_count, 0) + coalesce(n, 0) AS failure_count
 FROM tracking t FULL JOIN failed f ON t.ticket_no = f.ticket_no"""))
def _(spark, sf):
    failures = fx.tickets(spark, sf, "custkey", "status_id").where("status_id = 1").select(
        F.expr("'T' || CAST(custkey AS STRING)").alias("ticket_no")
    )
    return tracking.record_failures(fx.ticket_tracking(spark, sf), failures, tracking.TICKET_KEYS)


@query("t6_tickets_to_fetch", with_ctes(t("ticket_no"), fx.TICKET_TRACKING_SQL, f"""
 SELECT ticket_no FROM tickets LEFT JOIN tracking t USING (ticket_no)
 WHERE records_count IS NULL OR (failure_count < 3 AND (last_successful_fetch IS NULL
  OR last_successful_fetch < TIMESTAMP '{fx.EVENTS_NOW}' - INTERVAL '7' DAY))"""))
def _(spark, sf):
    return tracking.tickets_to_fetch(
        fx.tickets(spark, sf, "ticket_no"), fx.ticket_tracking(spark, sf), fx.EVENTS_NOW
    )


_FOLD_CTES = (*_CELL_CTES, _GRID, """brought AS (SELECT year, dist_id, status_id AS status, office_code AS office,
 count(*) AS records FROM tickets WHERE mode <> 'Phone' GROUP BY 1, 2, 3, 4)""", """
 out AS (SELECT year, dist_id, status, office, CASE WHEN records > 0 THEN 'success' ELSE 'failure' END AS outcome,
  coalesce(records, 0) AS records FROM grid LEFT JOIN brought USING (year, dist_id, status, office))""")


def _folded(spark, sf):
    landed = fx.tickets(spark, sf, *_CELLS).where("mode <> 'Phone'").withColumnsRenamed(
        {"status_id": "status", "office_code": "office"}
    )
    return tracking.fold_outcomes(_grid(spark, sf), landed, tracking.CELL_KEYS)


@query("t9_folded_outcomes", with_ctes(*_FOLD_CTES, "SELECT * FROM out"))
def _(spark, sf):
    return _folded(spark, sf).drop("attempt_seq")


@query("t9_outcome_totals", with_ctes(*_FOLD_CTES, """
 SELECT count(*) FILTER (outcome = 'success') AS success_count,
  count(*) FILTER (outcome = 'failure') AS failure_count FROM out"""))
def _(spark, sf):
    return tracking.outcome_totals(_folded(spark, sf))


@query("t_utc_fetch_times", with_ctes(fx.TICKET_TRACKING_SQL, """
 SELECT * REPLACE (last_successful_fetch - INTERVAL '330' MINUTE AS last_successful_fetch) FROM tracking"""))
def _(spark, sf):
    return tracking.with_utc_fetch_time(fx.ticket_tracking(spark, sf))


# --- documents ----------------------------------------------------------------------------------------------

_URLS = ("ticket_no", "document_url", "document_downloaded", "document_download_error", "seq")
_EXT = r"""CASE WHEN document_url IS NOT NULL THEN CASE WHEN regexp_matches(document_url, '~([a-zA-Z]*)$')
 THEN lower(regexp_extract(document_url, '~([a-zA-Z]*)$', 1)) ELSE 'bin' END END"""
_NAME = f"ticket_no || '_complaint_20020101_000000.' || {_EXT}"
_HTTP = "(lower(document_url) LIKE 'http://%' OR lower(document_url) LIKE 'https://%')"
_STORED_DOCS = r"""stored AS (SELECT DISTINCT regexp_extract(name, '^(.*?)_complaint_.*\.([^.]*)$', 1) AS ticket_no,
 regexp_extract(name, '\.([^.]*)$', 1) AS ext FROM listing WHERE contains(name, '_complaint_'))"""
_LISTED = (t(*_URLS), fx.LISTING_SQL, _STORED_DOCS, f"named AS (SELECT *, {_EXT} AS ext FROM tickets)")


@query("d1_document_names", with_ctes(t("ticket_no", "document_url"),
       f"SELECT ticket_no, {_NAME} AS document_name FROM tickets"))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "document_url")
    return documents.with_document_name(rows, fx.NOW).select("ticket_no", "document_name")


@query("d2_valid_urls", with_ctes(t("ticket_no", "document_url"), f"SELECT * FROM tickets WHERE {_HTTP}"))
def _(spark, sf):
    return documents.with_valid_url(fx.tickets(spark, sf, "ticket_no", "document_url"))


@query("d3_already_stored", with_ctes(*_LISTED, """
 SELECT ticket_no, document_url FROM named SEMI JOIN stored USING (ticket_no, ext)"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "document_url")
    return documents.already_stored(rows, fx.listing(spark, sf))


@query("d4_not_stored_any_case", with_ctes(*_LISTED, """
 SELECT ticket_no, document_url FROM named ANTI JOIN stored USING (ticket_no, ext)"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "document_url")
    shouted = fx.listing(spark, sf).withColumn(
        "name", F.concat(F.regexp_extract("name", r"^(.*\.)[^.]*$", 1), F.upper(F.regexp_extract("name", r"([^.]*)$", 1)))
    )
    return documents.not_stored(rows, shouted, any_case=True)


@query("d5_last_statuses", with_ctes(fx.ATTEMPTS_SQL, """
 SELECT ticket_no, arg_max(CASE WHEN error IS NOT NULL THEN 'failed' WHEN local_path IS NOT NULL THEN 'success'
  ELSE 'skipped' END, attempt_seq) AS status FROM attempts GROUP BY ticket_no"""))
def _(spark, sf):
    return documents.last_statuses(fx.attempts(spark, sf))


@query("d5_updates_from_attempts", with_ctes(fx.ATTEMPTS_SQL, """
 SELECT ticket_no, CASE WHEN error IS NULL THEN local_path END AS local_path,
  error IS NULL AND local_path IS NOT NULL AS success, error, attempt_seq FROM attempts"""))
def _(spark, sf):
    return documents.updates_from_attempts(fx.attempts(spark, sf))


@query("d6_download_plan", with_ctes(*_LISTED, f"""
 SELECT ticket_no, document_url, {_NAME} AS document_name FROM named ANTI JOIN stored USING (ticket_no, ext)
 WHERE {_NO_DOC} AND document_download_error IS NULL AND {_HTTP}"""))
def _(spark, sf):
    return documents.download_plan(fx.tickets(spark, sf, *_URLS), fx.listing(spark, sf), fx.NOW)


_NUMBERED = ("ticket_no", "document_url", "document_downloaded")
_PENDING = (t(*_NUMBERED), """numbered AS (SELECT * REPLACE ('GOV' || substr(ticket_no, 2) AS ticket_no) FROM tickets)""", """
 seen AS (SELECT DISTINCT regexp_extract(ticket_no || '_compliant_x.pdf', '([A-Z]{2,4}[0-9]*)(_compliant)*', 0) AS found
  FROM numbered WHERE document_downloaded), plain AS (SELECT DISTINCT ticket_no FROM numbered WHERE document_downloaded IS NULL),
 pending AS (SELECT DISTINCT ticket_no FROM numbered WHERE document_url IS DISTINCT FROM ''
  AND ticket_no NOT IN (SELECT found FROM seen) AND ticket_no NOT IN (SELECT ticket_no FROM plain))""")


def _pending(spark, sf):
    """Downloaded tickets are stored with a suffix that hides the ticket from the name
    pattern; tickets of unknown state are stored under their plain number."""
    rows = fx.tickets(spark, sf, *_NUMBERED).withColumn("ticket_no", F.expr("'GOV' || substr(ticket_no, 2)"))
    stored = rows.where("document_downloaded OR document_downloaded IS NULL").select(
        F.when(F.col("document_downloaded"), F.concat("ticket_no", F.lit("_compliant_x.pdf")))
        .otherwise(F.concat("ticket_no", F.lit("_complaint_x.pdf"))).alias("name")
    )
    return documents.pending_tickets(rows, stored)


@query("t10_pending_tickets", with_ctes(*_PENDING, "SELECT ticket_no FROM pending"))
def _(spark, sf):
    return _pending(spark, sf)


@query("t11_first_pending", with_ctes(*_PENDING, "SELECT ticket_no FROM pending ORDER BY ticket_no LIMIT 100"))
def _(spark, sf):
    return documents.first_pending(_pending(spark, sf), 100)
