"""Exploratory, action-history and scalar-function queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.functions import dates, naming, numbers as num, text as tx
from casewright.operators import actions as ops, lookup, profile, reports
from casewright.plans import fixtures as fx
from casewright.plans.registry import query, with_ctes
from casewright.plans.report_queries import (
    ASCII_SQL, CHANNEL_SQL, DAYS_SQL, MERGED_SQL, STACKED_SQL, TOPIC_SQL,
    _FEED_TICKETS, counts_sql, pct, share_sql, t,
)
from casewright.sources.landing import union_batches

CHIEF = "Office of Chief Minister"
ONLINE = C.CHANNEL_MODES["online"]

# --- shapes and missing values ------------------------------------------------------------


@query("e1_duplicate_tickets", with_ctes(_FEED_TICKETS, STACKED_SQL,
       "SELECT CAST(count(*) - count(DISTINCT ticket_no) AS BIGINT) AS duplicate_rows FROM stacked"))
def _(spark, sf):
    stacked = union_batches(*fx.feeds(spark, sf, "ticket_no").values())
    return profile.duplicate_rows(stacked, "ticket_no")


@query("e2_shape", with_ctes(t("ticket_no", "mode", "status_id"),
       "SELECT count(*) AS row_count, 3 AS column_count FROM tickets"))
def _(spark, sf):
    return profile.shape(fx.tickets(spark, sf, "ticket_no", "mode", "status_id"))


_PROFILED = ("ticket_no", "complaint_text", "block", "mode", "tagged_date", "status_id", "seq", "govt_ticket")


def _profile_sql() -> str:
    kinds = {"ticket_no": "string", "complaint_text": "string", "block": "string", "mode": "string",
             "tagged_date": "timestamp_ntz", "status_id": "int", "seq": "bigint", "govt_ticket": "boolean"}

    def row(c: str) -> str:
        kind = kinds[c]
        numeric, textual = kind in ("int", "bigint"), kind == "string"
        mean = f"avg({c})" if numeric else "CAST(NULL AS DOUBLE)"
        words = (f"CAST(sum(length(regexp_replace({c}, '[^ ]+', 'x', 'g')) - length(replace("
                 f"regexp_replace({c}, '[^ ]+', 'x', 'g'), 'x', ''))) AS BIGINT)"
                 if textual else "CAST(NULL AS BIGINT)")
        return (f"SELECT '{c}' AS column_name, '{kind}' AS column_type, count(*) - count({c}) AS missing, "
                f"{pct(f'count(*) - count({c})', 'count(*)', 2)} AS missing_pct, "
                f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
                f"{mean} AS mean_value, {words} AS total_words FROM tickets")
    return with_ctes(t(*_PROFILED), " UNION ALL ".join(row(c) for c in _PROFILED))


@query("e3_column_profile", _profile_sql())
def _(spark, sf):
    return profile.column_profile(fx.tickets(spark, sf, *_PROFILED))


@query("e3_column_sketch")
def _(spark, sf):
    return profile.column_sketch(fx.tickets(spark, sf, *_PROFILED))


def _sketch_check_sql() -> str:
    numeric = ("status_id", "seq")
    return with_ctes(t(*_PROFILED), " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_exact, TRUE AS distinct_close, "
        f"{'TRUE' if c in numeric else 'CAST(NULL AS BOOLEAN)'} AS quartiles_close FROM tickets" for c in _PROFILED))


@query("e3_sketch_check", _sketch_check_sql())
def _(spark, sf):
    return profile.sketch_check(fx.tickets(spark, sf, *_PROFILED))


@query("e4_missing_block_on_website", with_ctes(t("mode", "block"),
       "SELECT count(*) FILTER (mode = 'Website' AND block IS NULL) AS missing FROM tickets"))
def _(spark, sf):
    return profile.missing_where(fx.tickets(spark, sf, "mode", "block"), F.col("mode") == "Website", "block")


# --- dates -----------------------------------------------------------------------------------


@query("e5_weekday_counts", with_ctes(t("created_on"),
       "SELECT dayname(created_on) AS weekday, count(*) AS count FROM tickets GROUP BY 1"))
def _(spark, sf):
    return profile.weekday_counts(fx.tickets(spark, sf, "created_on"))


@query("e6_month_counts", with_ctes(t("created_on"),
       "SELECT monthname(created_on) AS month, count(*) AS count FROM tickets GROUP BY 1"))
def _(spark, sf):
    return profile.month_counts(fx.tickets(spark, sf, "created_on"))


# --- filtered counts ----------------------------------------------------------------------------


@query("e7_district_counts", with_ctes(t("district"), counts_sql("tickets", "district")))
def _(spark, sf):
    return reports.counts(fx.tickets(spark, sf, "district"), "district")


@query("e7_online_office_counts", with_ctes(t("office", "mode"),
       counts_sql("tickets", "office", CHANNEL_SQL["online"])))
def _(spark, sf):
    rows = lookup.tickets_where(fx.tickets(spark, sf, "office", "mode"), modes=ONLINE)
    return reports.counts(rows, "office")


def _register_chief(key: str):
    @query(f"e7_chief_online_{key}_counts", with_ctes(t("office", "mode", key),
           counts_sql("tickets", key, f"{CHANNEL_SQL['online']} AND office = '{CHIEF}'")))
    def _(spark, sf):
        rows = fx.tickets(spark, sf, "office", "mode", key)
        return reports.counts(lookup.tickets_where(rows, modes=ONLINE, office=CHIEF), key)


_register_chief("dept")
_register_chief("subcategory")


@query("e8_chief_category_share", with_ctes(t("office", "category"),
       share_sql("tickets", "category", 1, f"office = '{CHIEF}'")))
def _(spark, sf):
    rows = lookup.tickets_where(fx.tickets(spark, sf, "office", "category"), office=CHIEF)
    return reports.share(rows, "category")


@query("e8_mode_share", with_ctes(t("mode"), share_sql("tickets", "mode")))
def _(spark, sf):
    return reports.share(fx.tickets(spark, sf, "mode"), "mode")


# --- repeated texts --------------------------------------------------------------------------------

_TEXTS = "texts AS (SELECT mode, complaint_text, count(*) AS n FROM tickets WHERE mode IS NOT NULL GROUP BY 1, 2)"


@query("e9_text_flags", with_ctes(t("mode", "complaint_text"), _TEXTS, """
 SELECT mode, complaint_text, n AS count, n > 10 AS repeated_text,
  CAST(length(complaint_text) AS INT) AS length, length(complaint_text) > 10 AND n > 10 AS classified_text
 FROM texts WHERE complaint_text IS NOT NULL"""))
def _(spark, sf):
    return profile.text_flags(fx.tickets(spark, sf, "ticket_no", "mode", "complaint_text"), texts=partial(fx.with_texts, spark, sf))


def _flagged_sql(where: str) -> str:
    return with_ctes(t("mode", "complaint_text"), _TEXTS, f"""
 SELECT mode, CAST(sum(n) FILTER ({where}) AS BIGINT) AS count_x, CAST(sum(n) AS BIGINT) AS count_y,
  {pct(f'sum(n) FILTER ({where})', 'sum(n)', 2)} AS pct
 FROM texts GROUP BY mode HAVING count(*) FILTER ({where}) > 0""")


@query("e10_repeated_share", _flagged_sql("n > 10 AND complaint_text IS NOT NULL"))
def _(spark, sf):
    return profile.repeated_share(fx.tickets(spark, sf, "mode", "complaint_text"))


@query("e11_classified_share", _flagged_sql("n > 10 AND length(complaint_text) > 10"))
def _(spark, sf):
    return profile.classified_share(fx.tickets(spark, sf, "mode", "complaint_text"))


_LOWER = "texts AS (SELECT lower(complaint_text) AS complaint_text, count(*) AS n FROM tickets WHERE complaint_text IS NOT NULL GROUP BY 1)"


@query("e12_distinct_texts", with_ctes(t("complaint_text"), _LOWER,
       "SELECT complaint_text, n AS count, CAST(length(complaint_text) AS INT) AS length FROM texts"))
def _(spark, sf):
    return profile.distinct_texts(fx.tickets(spark, sf, "ticket_no", "complaint_text"), texts=partial(fx.with_texts, spark, sf))


@query("e13_distinct_text_totals", with_ctes(t("complaint_text"), _LOWER, """
 SELECT count(*) AS distinct_texts,
  CAST(coalesce(sum(n) FILTER (length(complaint_text) < 100), 0) AS BIGINT) AS short_rows,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS repeated_rows FROM texts"""))
def _(spark, sf):
    return profile.distinct_text_totals(fx.tickets(spark, sf, "complaint_text"))


_MODE_TEXTS = """texts AS (SELECT mode, lower(complaint_text) AS complaint_text, count(*) AS n FROM tickets
 WHERE mode IS NOT NULL AND complaint_text IS NOT NULL GROUP BY 1, 2)"""


def _register_mode_texts(mode: str, only: str, test: str):
    @query(f"e14_{mode.lower()}_{only}_texts", with_ctes(t("mode", "complaint_text"), _MODE_TEXTS,
           f"SELECT mode, complaint_text, n AS count FROM texts WHERE mode = '{mode}' AND n {test}"))
    def _(spark, sf):
        return profile.mode_texts(fx.tickets(spark, sf, "mode", "complaint_text"), mode, only)


for _mode in ("Website", "Whatsapp", "Physical", "Letter"):
    _register_mode_texts(_mode, "repeated", "> 1")
for _mode in ("Physical", "Letter"):
    _register_mode_texts(_mode, "single", "= 1")


@query("e14_mode_text_summary", with_ctes(t("mode", "complaint_text"), _MODE_TEXTS, f"""
 SELECT mode, CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_texts,
  count(*) FILTER (n > 1) AS frequent_texts,
  {pct('coalesce(sum(n) FILTER (n > 1), 0)', 'sum(n)')} AS frequent_pct
 FROM texts GROUP BY mode"""))
def _(spark, sf):
    return profile.mode_text_summary(fx.tickets(spark, sf, "mode", "complaint_text"))


@query("e15_text_contains", with_ctes(t("ticket_no", "complaint_text"), """
 SELECT ticket_no FROM tickets WHERE contains(lower(complaint_text), 'land ')"""))
def _(spark, sf):
    rows = profile.lowered(fx.tickets(spark, sf, "ticket_no", "complaint_text"))
    return lookup.tickets_where(rows, contains=["land "]).select("ticket_no")


@query("e15_letter_singles_without_phrases", with_ctes(t("mode", "complaint_text"), _MODE_TEXTS, """
 SELECT mode, complaint_text, n AS count FROM texts WHERE mode = 'Letter' AND n = 1
 AND NOT contains(complaint_text, 'pmay') AND NOT contains(complaint_text, 'subhadra') AND NOT contains(complaint_text, 'land')"""))
def _(spark, sf):
    texts = profile.mode_texts(fx.tickets(spark, sf, "mode", "complaint_text"), "Letter", "single")
    return lookup.tickets_where(texts, contains_none=["pmay", "subhadra", "land"])


@query("e15_website_without_phrases", with_ctes(t("mode", "complaint_text"), """
 SELECT lower(complaint_text) AS complaint_text, count(*) AS count FROM tickets WHERE mode = 'Website'
 AND NOT contains(lower(complaint_text), 'ration card') AND NOT contains(lower(complaint_text), 'financial help') GROUP BY 1"""))
def _(spark, sf):
    rows = profile.lowered(fx.tickets(spark, sf, "mode", "complaint_text"))
    rows = lookup.tickets_where(rows, modes=["Website"], contains_none=["ration card", "financial help"])
    return reports.counts(rows, "complaint_text")


# --- senders -------------------------------------------------------------------------------------------

_SENDERS = """senders AS (SELECT petitioner_mobile, count(*) AS n FROM tickets
 WHERE mode = 'Whatsapp' GROUP BY 1)"""


@query("e16_heavy_senders", with_ctes(t("mode", "petitioner_mobile"), _SENDERS, f"""
 SELECT CAST(coalesce(sum(n) FILTER (n > 10), 0) AS BIGINT) AS heavy_rows, CAST(sum(n) AS BIGINT) AS mode_rows,
  {pct('coalesce(sum(n) FILTER (n > 10), 0)', 'sum(n)')} AS heavy_pct FROM senders"""))
def _(spark, sf):
    return profile.heavy_senders(fx.tickets(spark, sf, "mode", "petitioner_mobile"), "Whatsapp")


_SENDER = ("ticket_no", "mode", "petitioner_mobile", "created_on")


@query("e17_repeat_sender_rows", with_ctes(t(*_SENDER), _SENDERS, """
 SELECT ticket_no, mode, petitioner_mobile, created_on FROM tickets
 WHERE mode = 'Whatsapp' AND petitioner_mobile IN (SELECT petitioner_mobile FROM senders WHERE n > 1)"""))
def _(spark, sf):
    return profile.repeat_sender_rows(fx.tickets(spark, sf, *_SENDER), "Whatsapp")


# --- action history ---------------------------------------------------------------------------------------

A = fx.actions_sql()


@query("e18_distinct_action_tickets", with_ctes(A,
       "SELECT count(DISTINCT ticket_no) AS distinct_tickets FROM actions"))
def _(spark, sf):
    return ops.distinct_tickets(fx.actions(spark, sf, "ticket_no"))


@query("e18_remark_counts", with_ctes(A, counts_sql("actions", "action_taken_remark")))
def _(spark, sf):
    return ops.remark_counts(fx.actions(spark, sf, "action_taken_remark"))


@query("e18_distinct_statuses", with_ctes(A, "SELECT DISTINCT action_status FROM actions"))
def _(spark, sf):
    return ops.distinct_statuses(fx.actions(spark, sf, "action_status"))


@query("e19_actions_of_ticket", with_ctes(A,
       "SELECT ticket_no, action_taken_date, action_status FROM actions WHERE ticket_no = 'T7'"))
def _(spark, sf):
    rows = fx.actions(spark, sf, "ticket_no", "action_taken_date", "action_status")
    return lookup.actions_by_ticket(rows, "T7")


_FLAG_NAMES = C.ACTION_STATUSES
_OTHER_SQL = "coalesce(action_status NOT IN ({}), true)".format(", ".join(f"'{s}'" for s in _FLAG_NAMES))
_FLAGS_SQL = ", ".join(f"action_status = '{s}' AS \"{s}\"" for s in _FLAG_NAMES) + f', {_OTHER_SQL} AS "Other"'
_TOKENS = ("tokens AS (SELECT ticket_no, "
           + ", ".join(f"count(*) FILTER (action_status = '{s}') AS \"{s}\"" for s in _FLAG_NAMES)
           + f', count(*) FILTER ({_OTHER_SQL}) AS "Other" FROM actions GROUP BY ticket_no)')
_SUM = " + ".join(f'"{s}"' for s in _FLAG_NAMES)


@query("h1_status_flags", with_ctes(A, f"SELECT seq, ticket_no, action_status, {_FLAGS_SQL} FROM actions"))
def _(spark, sf):
    return ops.with_status_flags(fx.actions(spark, sf, "seq", "ticket_no", "action_status"))


@query("h1_status_counts", with_ctes(A, "SELECT action_status, count(*) AS count FROM actions GROUP BY 1"))
def _(spark, sf):
    return ops.status_counts(fx.actions(spark, sf, "action_status"))


@query("h2_reminders", with_ctes(A, f"""
 SELECT seq, ticket_no, action_status, {_FLAGS_SQL} FROM actions WHERE action_status = 'Reminder Sent'"""))
def _(spark, sf):
    return ops.flagged(fx.actions(spark, sf, "seq", "ticket_no", "action_status"), "Reminder Sent")


def _tokens(spark, sf):
    return ops.status_tokens(fx.actions(spark, sf, "ticket_no", "action_status"))


@query("h3_status_tokens", with_ctes(A, _TOKENS, "SELECT * FROM tokens"))
def _(spark, sf):
    return _tokens(spark, sf)


@query("h4_assigned_and_registered_totals", with_ctes(A, _TOKENS, "SELECT count(*) AS tickets, " + ", ".join(
    f'CAST(coalesce(sum("{s}"), 0) AS BIGINT) AS "{s}"' for s in _FLAG_NAMES)
    + ' FROM tokens WHERE "Complaint Assigned" > 0 AND "Complaint Register" > 0'))
def _(spark, sf):
    return ops.token_totals(_tokens(spark, sf))


@query("h5_token_sum_distribution", with_ctes(A, _TOKENS,
       f"SELECT {_SUM} AS sum, count(*) AS count FROM tokens GROUP BY 1"))
def _(spark, sf):
    return ops.token_sum_distribution(fx.actions(spark, sf, "ticket_no", "action_status"))


@query("h6_busy_ticket_actions", with_ctes(A, _TOKENS, f"""
 SELECT seq, ticket_no, action_status FROM actions
 WHERE ticket_no IN (SELECT ticket_no FROM tokens WHERE {_SUM} > 70)"""))
def _(spark, sf):
    return ops.busy_ticket_actions(fx.actions(spark, sf, "seq", "ticket_no", "action_status"), 70)


def _span(filtered: str = "") -> str:
    f = f" FILTER ({filtered})" if filtered else ""
    return (f"round_even((epoch_us(max(action_taken_date){f}) - epoch_us(min(action_taken_date){f}))"
            " / 86400000000.0::DOUBLE, 1)")


@query("h7_forwarding_savings", with_ctes(A, f"""times AS (SELECT ticket_no, {_span()} AS total_days_diff,
  {_span("action_status IN ('Complaint Register', 'Forward', 'Forwarded To Subordinate')")} AS days_to_fw
 FROM actions GROUP BY ticket_no)""", f"""
 SELECT ticket_no, total_days_diff, days_to_fw, {pct('days_to_fw', 'total_days_diff')} AS potential_savings
 FROM times"""))
def _(spark, sf):
    return ops.forwarding_times(fx.actions(spark, sf, "ticket_no", "action_taken_date", "action_status"))


# --- scalar functions over whole columns ---------------------------------------------------------------------


@query("f_text_functions", with_ctes(t("ticket_no", "complaint_text", "office"), rf"""
 SELECT ticket_no, md5(lower(complaint_text)) AS lower_md5, CAST(length(complaint_text) AS INT) AS text_length,
  contains(complaint_text, 'e') OR contains(complaint_text, 'land') AS has_any,
  replace(office, 'Superintendent', 'Supertendent') AS replaced, {TOPIC_SQL} AS topic,
  coalesce({ASCII_SQL}, false) AS mostly_ascii
 FROM tickets"""))
def _(spark, sf):
    return fx.tickets(spark, sf, "ticket_no", "complaint_text", "office").select(
        "ticket_no", F.md5(F.lower("complaint_text")).alias("lower_md5"),
        F.length("complaint_text").alias("text_length"),
        tx.contains_any("complaint_text", ["e", "land"]).alias("has_any"),
        tx.replace_literal("office", "Superintendent", "Supertendent").alias("replaced"),
        tx.topic_of("complaint_text").alias("topic"),
        tx.is_mostly_ascii("complaint_text").alias("mostly_ascii"),
    )


@query("f_ascii_share_of_documents", r"""
 SELECT doc_id, length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / nullif(length(text), 0)::DOUBLE >= 0.9 AS english
 FROM documents""")
def _(spark, sf):
    return fx.read(spark, sf, "documents").select(
        "doc_id", tx.is_mostly_ascii("text").alias("english")
    )


@query("f_naming_functions", with_ctes(t("ticket_no", "document_url"), r"""
 SELECT ticket_no, document_url,
  CASE WHEN document_url IS NOT NULL THEN CASE WHEN regexp_matches(document_url, '~([a-zA-Z]*)$')
   THEN lower(regexp_extract(document_url, '~([a-zA-Z]*)$', 1)) ELSE 'bin' END END AS extension,
  coalesce(lower(document_url) LIKE 'http://%' OR lower(document_url) LIKE 'https://%', false) AS web,
  nullif(regexp_extract('AB' || substr(ticket_no, 2) || '_compliant_x.pdf', '([A-Z]{2,4}[0-9]*)(_compliant)*', 0), '') AS named
 FROM tickets"""))
def _(spark, sf):
    return fx.tickets(spark, sf, "ticket_no", "document_url").select(
        "ticket_no", "document_url",
        naming.url_extension("document_url").alias("extension"),
        tx.has_web_scheme("document_url").alias("web"),
        naming.ticket_in_name(F.expr("'AB' || substr(ticket_no, 2) || '_compliant_x.pdf'")).alias("named"),
    )


@query("f_date_functions", with_ctes(t("ticket_no", "created_on", "resolved_on"), f"""
 SELECT ticket_no, {DAYS_SQL} AS elapsed,
  (epoch_us(resolved_on) - epoch_us(created_on)) / 86400000000.0::DOUBLE AS fraction,
  date_diff('day', created_on, resolved_on) AS calendar, date_trunc('day', created_on)::TIMESTAMP AS day_start,
  dayname(created_on) AS weekday, monthname(created_on) AS month,
  strftime(created_on, '%Y%m%d_%H%M%S') AS stamp,
  created_on - INTERVAL '7' DAY AS week_before, created_on - INTERVAL '330' MINUTE AS in_utc,
  created_on AS from_millis
 FROM tickets"""))
def _(spark, sf):
    created = F.col("created_on")
    return fx.tickets(spark, sf, "ticket_no", "created_on", "resolved_on").select(
        "ticket_no", dates.elapsed_days("created_on", "resolved_on").alias("elapsed"),
        dates.fractional_days("created_on", "resolved_on").alias("fraction"),
        dates.calendar_days("created_on", "resolved_on").alias("calendar"),
        dates.day_start("created_on").alias("day_start"),
        dates.weekday_name("created_on").alias("weekday"), dates.month_name("created_on").alias("month"),
        F.date_format("created_on", "yyyyMMdd_HHmmss").alias("stamp"),
        dates.days_before(created, 7).alias("week_before"),
        dates.local_to_utc("created_on", C.SOURCE_TIME_ZONE).alias("in_utc"),
        dates.from_epoch_millis(
            F.timestamp_diff("MILLISECOND", dates.ntz("1970-01-01"), created)
        ).alias("from_millis"),
    )


@query("f_number_functions", """
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 4, 0) AS whole,
  round_even(l_quantity / 8, 1) AS tenth, CAST(round_even(l_quantity / 4, 0) AS BIGINT) AS as_int,
  round_even(l_quantity / nullif(l_linenumber - 1, 0) * 100, 1) AS pct,
  coalesce(l_quantity / nullif(l_linenumber - 1, 0), 0.0) AS filled
 FROM lineitem""")
def _(spark, sf):
    q = F.col("l_quantity")
    return fx.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", num.rounded(q / 4).alias("whole"),
        num.rounded(q / 8, 1).alias("tenth"), num.rounded(q / 4).cast("bigint").alias("as_int"),
        num.percent(q, F.col("l_linenumber") - 1).alias("pct"),
        num.zero_if_null(F.try_divide(q, F.col("l_linenumber") - 1)).alias("filled"),
    )


@query("f_recodes", with_ctes(t("ticket_no", "mode", "benefitted", "category"), f"""
 SELECT ticket_no, mode, benefitted, {MERGED_SQL} AS category,
  CASE WHEN {CHANNEL_SQL['online']} THEN 'online' WHEN {CHANNEL_SQL['offline']} THEN 'offline'
   WHEN {CHANNEL_SQL['freetext']} THEN 'freetext' ELSE 'Urgent' END AS channel,
  CASE benefitted WHEN 'Yes' THEN true WHEN 'No' THEN false END AS benefitted_bool
 FROM tickets"""))
def _(spark, sf):
    return lookup.with_recodes(fx.tickets(spark, sf, "ticket_no", "mode", "benefitted", "category"))


@query("f_json_access", """
 SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_extract(props, '$.absent') IS NULL AS absent
 FROM events""")
def _(spark, sf):
    body = F.try_parse_json("props")
    return fx.read(spark, sf, "events").select(
        "event_id", F.try_variant_get(body, "$.k", "int").alias("k"),
        F.variant_get(body, "$.absent", "variant").isNull().alias("absent"),
    )
