"""Report queries (analysis table, status, category and channel reports)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.operators import profile, reports
from casewright.plans import fixtures as fx
from casewright.plans.registry import query, with_ctes

AS_OF = fx.AS_OF
AS_OF_SQL = f"TIMESTAMP '{fx.AS_OF}'"
DAYS_SQL = "CAST(floor((epoch_us(resolved_on) - epoch_us(created_on)) / 86400000000.0) AS BIGINT)"
OPEN_SQL = (
    f"CASE WHEN resolved_on IS NOT NULL THEN {DAYS_SQL} ELSE "
    f"CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(created_on)) / 86400000000.0) AS BIGINT) END"
)
CHANNEL_SQL = {
    "online": "mode IN ('Website', 'Whatsapp', 'Mobile')",
    "offline": f"mode IN ('Joint Hearing', 'Physical', '{C.WIRE_VALUES["weekly_mode"]}')",
    "freetext": "mode IN ('Letter', 'Email')",
}
ANY_CHANNEL_SQL = "(" + " OR ".join(CHANNEL_SQL.values()) + ")"
MERGED_SQL = "CASE WHEN category IN ('General', 'Miscellaneous') THEN 'General & Misc' ELSE category END"
TOPIC_SQL = """CASE WHEN regexp_matches(lower(complaint_text), 'pmay|pmagy|housing|awas|yojana|yojna|house') THEN 'Housing'
 WHEN contains(lower(complaint_text), 'subhadra') THEN 'Subhadra Scheme'
 WHEN contains(lower(complaint_text), 'ration card') THEN 'Ration Card' ELSE 'Other' END"""
ASCII_SQL = r"length(regexp_replace(complaint_text, '[^\x00-\x7F]', '', 'g')) / nullif(length(complaint_text), 0)::DOUBLE >= 0.9"
WELFARE = ("Social Welfare", "Panchayati Raj & Drinking Water")
REVENUE = "Revenue & Disaster Management"


def t(*columns: str) -> str:
    return fx.tickets_sql(*columns)


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"round_even(({part})::DOUBLE / nullif({whole}, 0) * 100, {digits})"


def share_sql(source: str, key: str, digits: int | None = 1, where: str = "TRUE", keep_nulls=False) -> str:
    known = "TRUE" if keep_nulls else f"{key} IS NOT NULL"
    value = "count(*)::DOUBLE / sum(count(*)) OVER () * 100"
    value = value if digits is None else f"round_even({value}, {digits})"
    return (
        f"SELECT {key}, count(*) AS count, {value} AS percent FROM {source} "
        f"WHERE {known} AND {where} GROUP BY {key}"
    )


def counts_sql(source: str, keys: str, where: str = "TRUE") -> str:
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"SELECT {keys}, count(*) AS count FROM {source} WHERE {known} AND {where} GROUP BY {keys}"


ENGLISH_SQL = f"""english AS (SELECT * REPLACE ({MERGED_SQL} AS category), {TOPIC_SQL} AS topic
 FROM tickets WHERE {ASCII_SQL})"""

# --- analysis table ------------------------------------------------------------------------

_FEED_COLUMNS = ("ticket_no", "office", "mode", "created_on", "escalation_date", "resolved_on")
STACKED_SQL = f"""stacked AS (
 SELECT ticket_no, replace(office, 'Superintendent of Police', 'Supertendent of Police') AS office, mode,
  CASE WHEN status_id = 0 THEN created_on ELSE created_on + INTERVAL '1' DAY END AS created_on,
  CAST(NULL AS TIMESTAMP) AS escalation_date, CAST(NULL AS TIMESTAMP) AS resolved_on, 0 AS status_id
 FROM tickets WHERE status_id = 0 OR ({fx.RELISTED})
 UNION ALL SELECT ticket_no, office, mode, created_on, escalation_date, resolved_on, status_id
 FROM tickets WHERE status_id <> 0)"""
_FEED_TICKETS = t(*_FEED_COLUMNS, "status_id", "priority")


@query("a1_analysis_table", with_ctes(_FEED_TICKETS, STACKED_SQL, """
 SELECT ticket_no, replace(office, 'Supertendent of Police', 'Superintendent of Police') AS office, mode,
  created_on, escalation_date, resolved_on, status_id
 FROM stacked QUALIFY row_number() OVER (PARTITION BY ticket_no ORDER BY created_on NULLS LAST,
  escalation_date NULLS LAST, resolved_on NULLS LAST, status_id) = 1"""))
def _(spark, sf):
    table = reports.analysis_table(fx.feeds(spark, sf, *_FEED_COLUMNS))
    return table.select(*_FEED_COLUMNS, "status_id")


@query("a1_analysis_then_stats", with_ctes(_FEED_TICKETS, STACKED_SQL, f"""
 SELECT replace(office, 'Supertendent of Police', 'Superintendent of Police') AS office,
  count(*) AS total_complaints,
  nullif(count(*) FILTER (status_id = 0), 0) AS count_unassigned,
  nullif(count(*) FILTER (status_id = 1), 0) AS count_pending,
  nullif(count(*) FILTER (status_id = 2), 0) AS count_disposed,
  {pct('nullif(count(*) FILTER (status_id = 0), 0)', 'count(*)')} AS perc_unassigned,
  {pct('nullif(count(*) FILTER (status_id = 1), 0)', 'count(*)')} AS perc_pending,
  {pct('nullif(count(*) FILTER (status_id = 2), 0)', 'count(*)')} AS perc_disposed
 FROM (SELECT * FROM stacked QUALIFY row_number() OVER (PARTITION BY ticket_no ORDER BY created_on NULLS LAST,
  escalation_date NULLS LAST, resolved_on NULLS LAST, status_id) = 1) WHERE office IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    return reports.overall_stats(reports.analysis_table(fx.feeds(spark, sf, *_FEED_COLUMNS)))


# --- status reports ---------------------------------------------------------------------------

OVERALL_SQL = with_ctes(t("office", "status_id"), f"""
 SELECT office, count(*) AS total_complaints,
  nullif(count(*) FILTER (status_id = 0), 0) AS count_unassigned,
  nullif(count(*) FILTER (status_id = 1), 0) AS count_pending,
  nullif(count(*) FILTER (status_id = 2), 0) AS count_disposed,
  {pct('nullif(count(*) FILTER (status_id = 0), 0)', 'count(*)')} AS perc_unassigned,
  {pct('nullif(count(*) FILTER (status_id = 1), 0)', 'count(*)')} AS perc_pending,
  {pct('nullif(count(*) FILTER (status_id = 2), 0)', 'count(*)')} AS perc_disposed
 FROM tickets WHERE office IS NOT NULL GROUP BY office ORDER BY office""")


@query("a2_overall_stats", OVERALL_SQL)
def overall(spark, sf):
    return reports.overall_stats(fx.tickets(spark, sf, "office", "status_id"))


_TIMES = ("office", "status_id", "created_on", "resolved_on", "benefitted")
_SO_FAR = f"date_diff('day', created_on, {AS_OF_SQL})"


def _time_metrics_sql(anchored: bool, twice: str = "") -> str:
    having = "HAVING count(*) FILTER (status_id = 2) > 0" if anchored else ""
    return with_ctes(t(*_TIMES), f"""
 SELECT office,
  coalesce(round_even(avg({DAYS_SQL}) FILTER (status_id = 2), 0), 0.0) AS {twice}avg_days_to_dispose,
  coalesce(round_even(avg({DAYS_SQL}) FILTER (status_id = 2 AND benefitted = 'Yes'), 0), 0.0) AS {twice}avg_days_to_benefit,
  coalesce(round_even(avg({_SO_FAR}) FILTER (status_id = 1), 0), 0.0) AS avg_days_open_without_disposal,
  coalesce(round_even(avg({_SO_FAR}) FILTER (status_id = 0), 0), 0.0) AS avg_days_without_assignment
 FROM tickets WHERE office IS NOT NULL GROUP BY office {having}""")


@query("a3_avg_time_metrics", _time_metrics_sql(True))
def _(spark, sf):
    return reports.avg_time_metrics(fx.tickets(spark, sf, *_TIMES), AS_OF)


@query("a3_avg_time_metrics_all_offices", _time_metrics_sql(False))
def _(spark, sf):
    return reports.avg_time_metrics(fx.tickets(spark, sf, *_TIMES), AS_OF, anchor=None)


@query("a3_avg_time_metrics_early_rounding", _time_metrics_sql(True, "avg_"))
def _(spark, sf):
    return reports.avg_time_metrics(fx.tickets(spark, sf, *_TIMES), AS_OF, round_early=True)


_YES = "count(*) FILTER (benefitted = 'Yes')"
_NO = "count(*) FILTER (benefitted = 'No')"
_ANSWERED = "count(*) FILTER (benefitted IN ('Yes', 'No'))"


@query("a4_disposal_by_office", with_ctes(t(*_TIMES), f"""
 SELECT office, {_ANSWERED} AS total_complaints, {_YES} AS disposed_and_benefitted,
  {_NO} AS disposed_without_benefit,
  coalesce({pct(_YES, _ANSWERED)}, 0.0) AS percent_benefitted,
  coalesce({pct(_NO, _ANSWERED)}, 0.0) AS percent_not_benefitted,
  coalesce(round_even(avg({DAYS_SQL}), 0), 0.0) AS days_to_dispose,
  coalesce(round_even(avg({DAYS_SQL}) FILTER (benefitted = 'Yes'), 0), 0.0) AS days_to_benefit
 FROM tickets WHERE status_id = 2 AND office IS NOT NULL GROUP BY office"""))
def _(spark, sf):
    return reports.status2_stats(fx.tickets(spark, sf, *_TIMES))


@query("a5_days_by_benefit", with_ctes(t(*_TIMES[1:]), f"""
 SELECT benefitted, avg({DAYS_SQL}) AS days_to_dispose FROM tickets
 WHERE status_id = 2 AND benefitted IS NOT NULL GROUP BY benefitted"""))
def _(spark, sf):
    return reports.days_by_benefit(fx.tickets(spark, sf, *_TIMES[1:]))


@query("a5_days_by_benefit_rounded", with_ctes(t(*_TIMES[1:]), f"""
 SELECT benefitted, round_even(avg({DAYS_SQL}), 2) AS days_to_dispose FROM tickets
 WHERE status_id = 2 AND benefitted IS NOT NULL GROUP BY benefitted"""))
def _(spark, sf):
    return reports.days_by_benefit(fx.tickets(spark, sf, *_TIMES[1:]), digits=2)


@query("a6_office_response_times", with_ctes(t(*_TIMES), f"""
 SELECT office, round_even(avg({DAYS_SQL}), 0) AS avg_days_to_dispose FROM tickets
 WHERE status_id = 2 AND office IS NOT NULL GROUP BY office"""))
def _(spark, sf):
    return reports.office_days(fx.tickets(spark, sf, *_TIMES))


def _benefit_sql(key: str) -> str:
    return with_ctes(t(key, "status_id", "benefitted"), f"""
 SELECT {key}, {_ANSWERED} AS total_complaints, {_YES} AS disposed_and_benefitted,
  {_NO} AS disposed_without_benefit, {pct(_YES, _ANSWERED)} AS percent_benefitted,
  {pct(_NO, _ANSWERED)} AS percent_not_benefitted
 FROM tickets WHERE status_id = 2 AND {key} IS NOT NULL GROUP BY {key}""")


@query("a14_benefit_by_category", _benefit_sql("category"))
def _(spark, sf):
    return reports.benefit_by(fx.tickets(spark, sf, "category", "status_id", "benefitted"), "category")


@query("a14_benefit_by_office", _benefit_sql("office"))
def _(spark, sf):
    return reports.benefit_by(fx.tickets(spark, sf, "office", "status_id", "benefitted"), "office")


@query("a15_benefit_by_mode", with_ctes(t("mode", "status_id", "benefitted"), f"""
 SELECT mode, count(*) AS total_complaints, {_YES} AS benefitted_complaints,
  {pct(_YES, 'count(*)')} AS percent_benefitted
 FROM tickets WHERE status_id = 2 AND mode IS NOT NULL GROUP BY mode"""))
def _(spark, sf):
    return reports.benefit_by_mode(fx.tickets(spark, sf, "mode", "status_id", "benefitted"))


def _register_share(name: str, key: str, digits: int | None, where: str = "TRUE", extra=()):
    @query(name, with_ctes(t(key, *extra), share_sql("tickets", key, digits, where)))
    def _(spark, sf):
        return reports.share(fx.tickets(spark, sf, key, *extra).where(where), key, digits)


_register_share("a16_status_share", "status_id", 2)
_register_share("a16_district_share", "district", None)
_register_share("a16_category_share", "category", 1)
_register_share("a16_mode_share", "mode", 1)
_register_share("a16_office_share", "office", 1)
_register_share("a16_benefit_share", "benefitted", 1, "status_id = 2", ("status_id",))


@query("a17_mean_days_to_dispose", with_ctes(t(*_TIMES[1:]), f"""
 SELECT avg({DAYS_SQL}) AS mean_days_to_dispose FROM tickets WHERE status_id = 2"""))
def _(spark, sf):
    return reports.mean_days_to_dispose(fx.tickets(spark, sf, *_TIMES[1:]))


@query("a17_slow_tail", with_ctes(t("ticket_no", *_TIMES[1:]), f"""
 SELECT ticket_no, status_id, created_on, resolved_on, benefitted, {DAYS_SQL} AS days_to_dispose
 FROM tickets WHERE status_id = 2 AND {DAYS_SQL} > 50"""))
def _(spark, sf):
    return reports.slow_tail(fx.tickets(spark, sf, "ticket_no", *_TIMES[1:]))


@query("a18_rows_per_ticket", with_ctes(_FEED_TICKETS, STACKED_SQL, counts_sql("stacked", "ticket_no")))
def _(spark, sf):
    return reports.rows_per_ticket(reports.union_batches(*fx.feeds(spark, sf, "ticket_no").values()))


@query("a18_unique_tickets", with_ctes(_FEED_TICKETS, STACKED_SQL,
       "SELECT count(DISTINCT ticket_no) AS unique_tickets FROM stacked"))
def _(spark, sf):
    return reports.unique_tickets(reports.union_batches(*fx.feeds(spark, sf, "ticket_no").values()))


# --- categories and topics -----------------------------------------------------------------------


@query("a7_category_overview", with_ctes(t("category"), f"merged AS (SELECT {MERGED_SQL} AS category FROM tickets)",
                                         share_sql("merged", "category")))
def _(spark, sf):
    return reports.category_overview(fx.tickets(spark, sf, "category"))


@query("a7_social_welfare_departments", with_ctes(t("category", "dept"),
       counts_sql("tickets", "dept", f"{MERGED_SQL} = 'Social Welfare'")))
def _(spark, sf):
    return reports.departments_of(fx.tickets(spark, sf, "category", "dept"), "Social Welfare")


_TOPIC = ("category", "dept", "complaint_text")
_WELFARE_SQL = f"category = '{WELFARE[0]}' AND dept = '{WELFARE[1]}'"


@query("a7_topic_mix", with_ctes(t(*_TOPIC), ENGLISH_SQL, share_sql("english", "topic", 1, _WELFARE_SQL)))
def _(spark, sf):
    return reports.topic_mix(fx.tickets(spark, sf, *_TOPIC), *WELFARE)


@query("a19_general_departments", with_ctes(t("category", "dept"),
       counts_sql("tickets", "dept", f"{MERGED_SQL} = 'General & Misc'")))
def _(spark, sf):
    return reports.departments_of(fx.tickets(spark, sf, "category", "dept"), "General & Misc")


@query("a19_other_by_department", with_ctes(t(*_TOPIC), ENGLISH_SQL,
       counts_sql("english", "dept", "topic = 'Other'")))
def _(spark, sf):
    return reports.topic_by(fx.tickets(spark, sf, *_TOPIC), "Other", "dept")


@query("a19_ration_card_elsewhere", with_ctes(t("ticket_no", "subcategory", *_TOPIC), ENGLISH_SQL, """
 SELECT ticket_no, subcategory, category, dept, topic FROM english
 WHERE topic = 'Ration Card' AND subcategory IS DISTINCT FROM 'Ration Card Issue'"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "subcategory", *_TOPIC)
    return reports.topic_outside_subcategory(rows, "Ration Card", "Ration Card Issue").drop("complaint_text")


@query("a19_ration_card_modes", with_ctes(t("mode", *_TOPIC), ENGLISH_SQL,
       counts_sql("english", "mode", f"topic = 'Ration Card' AND dept = '{WELFARE[1]}'")))
def _(spark, sf):
    return reports.topic_by(fx.tickets(spark, sf, "mode", *_TOPIC), "Ration Card", "mode", WELFARE[1])


@query("a19_land_mentions", with_ctes(t(*_TOPIC), ENGLISH_SQL, f"""
 SELECT count(*) FILTER (topic = 'Other' AND contains(lower(complaint_text), 'land')) AS mentions
 FROM english WHERE dept = '{REVENUE}'"""))
def _(spark, sf):
    return reports.topic_mentions(fx.tickets(spark, sf, *_TOPIC), "Other", REVENUE, "land")


@query("a19_subcategory_counts", with_ctes(t("subcategory", *_TOPIC), ENGLISH_SQL,
       counts_sql("english", "subcategory")))
def _(spark, sf):
    rows = reports.english_with_topic(fx.tickets(spark, sf, "subcategory", *_TOPIC))
    return reports.counts(rows, "subcategory")


@query("a19_text_counts", with_ctes(t("complaint_text"), counts_sql("tickets", "complaint_text")))
def _(spark, sf):
    return profile.text_counts(fx.tickets(spark, sf, "ticket_no", "complaint_text"), texts=partial(fx.with_texts, spark, sf))


@query("a19_offline_text_counts", with_ctes(t("complaint_text", "mode"),
       counts_sql("tickets", "complaint_text", CHANNEL_SQL["offline"])))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "complaint_text", "mode").where(F.col("mode").isin(*C.CHANNEL_MODES["offline"]))
    return reports.counts(rows, "complaint_text", ordered=False)


@query("a19_general_tickets", with_ctes(t("ticket_no", "category", "dept", "office"), f"""
 SELECT ticket_no, 'General & Misc' AS category, dept, office FROM tickets
 WHERE {MERGED_SQL} = 'General & Misc'"""))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "ticket_no", "category", "dept", "office")
    merged = rows.withColumn("category", reports.tx.merged_category("category"))
    return merged.where(F.col("category") == C.GENERAL_LABEL)


@query("a20_top_departments", with_ctes(t("category", "dept"),
       counts_sql("tickets", "dept", "category = 'Social Welfare'") + " ORDER BY count DESC, dept LIMIT 5"))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "category", "dept").where("category = 'Social Welfare'")
    return reports.top_values(rows, "dept")


# --- channels ---------------------------------------------------------------------------------------

_CHANNEL = ("office", "mode", "created_on", "resolved_on", "benefitted")


def _resolution_sql(anchored: bool) -> str:
    columns = [
        f"CAST(coalesce(round_even(avg({OPEN_SQL}) FILTER ({where}), 0), 0.0) AS BIGINT) AS avg_days_open_{c}"
        for c, where in CHANNEL_SQL.items()
    ] + [
        f"CAST(coalesce(round_even(avg({OPEN_SQL}) FILTER ({where} AND benefitted = 'Yes'), 0), 0.0) AS BIGINT)"
        f" AS avg_days_to_benefit_{c}"
        for c, where in CHANNEL_SQL.items()
    ]
    having = f"HAVING count(*) FILTER ({CHANNEL_SQL['online']}) > 0" if anchored else ""
    return with_ctes(t(*_CHANNEL), f"SELECT office, {', '.join(columns)} FROM tickets "
                                   f"WHERE office IS NOT NULL GROUP BY office {having}")


@query("a8_resolution_times", _resolution_sql(True))
def _(spark, sf):
    return reports.resolution_times(fx.tickets(spark, sf, *_CHANNEL), AS_OF)


@query("a8_resolution_times_all_offices", _resolution_sql(False))
def _(spark, sf):
    return reports.resolution_times(fx.tickets(spark, sf, *_CHANNEL), AS_OF, anchor=None)


def _per_channel_sql(key: str, columns) -> str:
    selects = [
        f"SELECT '{c}' AS {key}, {columns(where)} FROM tickets" for c, where in CHANNEL_SQL.items()
    ]
    return with_ctes(t(*_CHANNEL[1:]), " UNION ALL ".join(selects))


@query("a9_mode_summary", _per_channel_sql("mode", lambda w: f"""
  count(*) FILTER ({w}) AS total, count(*) FILTER ({w} AND benefitted = 'Yes') AS benefitted,
  coalesce({pct(f"count(*) FILTER ({w} AND benefitted = 'Yes')", f'count(*) FILTER ({w})')}, 0.0) AS "benefitted_rate_%",
  round_even(avg({OPEN_SQL}) FILTER ({w} AND benefitted = 'Yes'), 1) AS avg_days_till_benefit,
  round_even(avg({OPEN_SQL}) FILTER ({w}), 1) AS avg_days_till_disposed"""))
def _(spark, sf):
    return reports.mode_summary_table(fx.tickets(spark, sf, *_CHANNEL[1:]), AS_OF)


@query("a9b_channel_benefit_days", _per_channel_sql("channel", lambda w: f"""
  count(*) FILTER ({w}) AS n_complaints, count(*) FILTER ({w} AND benefitted = 'Yes') AS n_benefitted,
  {pct(f"count(*) FILTER ({w} AND benefitted = 'Yes')", f'count(*) FILTER ({w})')} AS benefitted_rate,
  round_even(avg({OPEN_SQL}) FILTER ({w} AND benefitted = 'Yes'), 0) AS avg_days_benefitted,
  round_even(avg({OPEN_SQL}) FILTER ({w}), 0) AS avg_days_open"""))
def _(spark, sf):
    return reports.channel_benefit_days(fx.tickets(spark, sf, *_CHANNEL[1:]), AS_OF)


_MODES = tuple(sorted({m for modes in C.CHANNEL_MODES.values() for m in modes} | {"Phone"}))


@query("a10_office_mode_shares", with_ctes(t("office", "mode"), """cells AS (
 SELECT office, mode, count(*) AS count FROM tickets WHERE office IS NOT NULL AND mode IS NOT NULL GROUP BY 1, 2)""", f"""
 SELECT office, mode, count, {pct('count', 'sum(count) OVER (PARTITION BY office)')} AS percent FROM cells"""))
def _(spark, sf):
    return reports.office_mode_shares(fx.tickets(spark, sf, "office", "mode"))


@query("a10_office_mode_pct", with_ctes(t("office", "mode"), f"""
 SELECT office, {', '.join(f"{pct(f"count(*) FILTER (mode = '{m}')", 'count(mode)')} AS \"{m}\"" for m in _MODES)}
 FROM tickets WHERE office IS NOT NULL GROUP BY office"""))
def _(spark, sf):
    return reports.office_mode_pct(fx.tickets(spark, sf, "office", "mode"), _MODES)


@query("a10_office_channel_summary", with_ctes(t("office", "mode"), f"""
 SELECT office, {', '.join(f"count(*) FILTER ({w}) AS {c}_count" for c, w in CHANNEL_SQL.items())},
 {', '.join(f"{pct(f'count(*) FILTER ({w})', 'count(*)')} AS {c}_percent" for c, w in CHANNEL_SQL.items())}
 FROM tickets WHERE office IS NOT NULL AND {ANY_CHANNEL_SQL} GROUP BY office"""))
def _(spark, sf):
    return reports.office_channel_summary(fx.tickets(spark, sf, "office", "mode"))


@query("a11_office_mode_matrix", with_ctes(t("office", "mode"), f"""
 SELECT office, count(mode) AS total,
 {', '.join(f"count(*) FILTER (mode = '{m}') AS \"{m}_count\"" for m in _MODES)},
 {', '.join(f"{pct(f"count(*) FILTER (mode = '{m}')", 'count(mode)')} AS \"{m}_percent\"" for m in _MODES)}
 FROM tickets WHERE office IS NOT NULL GROUP BY office"""))
def _(spark, sf):
    return reports.office_mode_matrix(fx.tickets(spark, sf, "office", "mode"), _MODES)


def _benefit_channel_sql(extra: str = "") -> str:
    return with_ctes(t("office", "mode", "benefitted"), f"""
 SELECT office, {extra}
 {', '.join(f"{pct(f'count(*) FILTER ({w})', 'count(*)')} AS {c}_benefitted_pct" for c, w in CHANNEL_SQL.items())}
 FROM tickets WHERE office IS NOT NULL AND benefitted = 'Yes' AND {ANY_CHANNEL_SQL} GROUP BY office""")


@query("a12_benefitted_pct_by_channel", _benefit_channel_sql())
def _(spark, sf):
    return reports.benefitted_pct_by_channel(fx.tickets(spark, sf, "office", "mode", "benefitted"))


@query("a12_benefitted_pct_with_total", _benefit_channel_sql("count(*) AS total_benefitted,"))
def _(spark, sf):
    rows = fx.tickets(spark, sf, "office", "mode", "benefitted")
    return reports.benefitted_pct_by_channel(rows, with_total=True)


def _register_overview(channel: str, where: str, key: str, keep_nulls: bool):
    suffix = "" if keep_nulls else "_known"
    source = f"picked AS (SELECT {MERGED_SQL if key == 'category' else key} AS {key} FROM tickets WHERE {where})"

    @query(f"a13_{channel.lower()}_by_{key}{suffix}",
           with_ctes(t(key, "mode"), source, share_sql("picked", key, keep_nulls=keep_nulls)))
    def _(spark, sf):
        return reports.channel_overview(fx.tickets(spark, sf, key, "mode"), channel, key, keep_nulls)


for _channel, _where in {**CHANNEL_SQL, "Urgent": f"NOT {ANY_CHANNEL_SQL}"}.items():
    for _key in ("office", "dept", "category"):
        _register_overview(_channel, _where, _key, True)
_register_overview("online", CHANNEL_SQL["online"], "dept", False)
