"""Streaming queries: landed envelopes committed by micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.plans import fixtures as fx
from casewright.plans.ingest_queries import FAULTY, OK
from casewright.plans.registry import query, with_ctes
from casewright.plans.report_queries import t
from casewright.session import run_folder
from casewright.sources.tables import open_table
from casewright.streaming import ingest

_KEPT = ("ticket_no", "office", "district", "status", "category", "created_on", "resolved_on", "govt_ticket")


@query("m12_streamed_complaints", with_ctes(t(*_KEPT, "document_url", "seq"), f"""
 SELECT {', '.join(_KEPT)}, false AS document_downloaded FROM tickets WHERE {OK} AND NOT ({FAULTY})"""))
def _(spark, sf):
    """Land the payloads as files, stream them into the complaint table, read it back."""
    landed = fx.payloads(spark, sf).select("value", F.col("seq").alias("ingest_seq"))
    kept = (*_KEPT, "document_downloaded")
    return _streamed(spark, landed, "complaints", kept).select(*kept)


@query("m12_streamed_districts", """
 SELECT n_nationkey AS dist_id, arg_max(n_name || ' ' || c_mktsegment, c_custkey) AS dist_name
 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey""")
def _(spark, sf):
    """One envelope per customer names its district; ids repeat, so the last name counts."""
    rows = fx.district_batch(spark, sf)
    record = F.to_json(F.struct(F.col("dist_id").alias("distId"), F.col("dist_name").alias("distName")))
    envelope = F.concat(F.lit('{"status":200,"distRes":['), record, F.lit("]}"))
    return _streamed(spark, rows.select(envelope.alias("value"), "ingest_seq"), "districts")


@query("m12_streamed_actions", with_ctes(fx.actions_sql(), f"""
 SELECT ticket_no, action_taken_by, (CASE seq % 3 WHEN 0 THEN date_trunc('second', action_taken_date)
   WHEN 1 THEN date_trunc('minute', action_taken_date) END)::TIMESTAMP AS action_taken_date,
  action_taken_remark, action_status, complaint_status_with_authority
 FROM actions WHERE action_status <> 'Complaint Assigned'
 QUALIFY row_number() OVER (PARTITION BY {', '.join(C.ACTION_KEY)} ORDER BY seq) = 1"""))
def _(spark, sf):
    """Action envelopes by request; the first of a five-part key counts."""
    landed = fx.action_payloads(spark, sf).select("request_ticket", "value", F.col("seq").alias("ingest_seq"))
    return _streamed(spark, landed, "actions")


def _streamed(spark, landed, kind: str, columns=None):
    folder = run_folder(spark, "stream")
    landed.write.option("compression", "lz4").json(f"{folder}/landing")
    ingest.start(spark, kind, f"{folder}/landing", f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return open_table(spark, f"{folder}/tables", ingest.FEEDS[kind].table).read(columns=columns)
