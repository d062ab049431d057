"""One weekly run end to end: plan, land, ingest, record, plan again."""

import json

from helpers import complaint, envelope, frame, ts, values
from pyspark.sql import functions as F

from casewright.operators import tracking
from casewright.plans import weekly
from casewright.streaming import ingest

NOW = "2025-07-01 12:00:00"
ACTION = {"action_taken_by": "u", "action_taken_date": None, "action_taken_remark": "r",
          "action_status": "Forward", "complaint_status_with_authority": "Open"}


def land(folder, *rows):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def test_weekly_run(spark, tmp_path):
    root = str(tmp_path / "tables")
    tables = weekly.open_tables(spark, root)
    ingest.ingest_once(spark, "districts", land(tmp_path / "d", {
        "value": envelope({"distId": 1, "distName": "A"}, {"distId": 2, "distName": "B"}, key="distRes"),
        "ingest_seq": 1}), root)
    cells = weekly.plan_complaint_requests(tables, [2025], NOW)
    assert cells.count() == 2 * 3 * 7

    ingest.ingest_once(spark, "complaints", land(tmp_path / "c", {
        "value": envelope(complaint(), complaint(ticketNumber="T2", Document="www.x"), complaint(ticketNumber="T3", govtTicket="?")),
        "ingest_seq": 1}), root)
    assert values(tables["complaints"].read(), "ticket_no", "document_downloaded") == [("T1", False), ("T2", False)]

    landed = frame(spark, "year int, dist_id int, status int, office int", (2025, 1, 2, 6), (2025, 1, 2, 6))
    totals = weekly.record_requests(tables["cell_tracking"], cells, landed, tracking.CELL_KEYS, NOW)
    assert tuple(totals.first()) == (1, 41)
    # The service gives up on a cell after one failure; forced cells come back.
    assert weekly.plan_complaint_requests(tables, [2025], NOW).count() == 0
    assert weekly.plan_complaint_requests(tables, [2025], NOW, failures=3).count() == 41
    forced = landed.limit(1)
    assert weekly.plan_complaint_requests(tables, [2025], NOW, forced).count() == 1

    plan = weekly.plan_downloads(tables, frame(spark, "name string", ("T9_complaint_1.pdf",)), NOW)
    assert values(plan, "document_name") == ["T1_complaint_20250701_120000.pdf"]

    assert values(weekly.plan_action_requests(tables, NOW), "ticket_no") == ["T1", "T2"]
    for _ in range(2):  # a second load of the same answers changes nothing
        folder = str(tmp_path / "a")
        if not (tmp_path / "a").exists():
            land(tmp_path / "a", {"request_ticket": "T1", "value": envelope(ACTION, {**ACTION, "action_taken_by": "v"}, key="actionHistory"), "ingest_seq": 1})
        ingest.ingest_once(spark, "actions", folder, root)
    actions = tables["action_history"].read()
    assert values(actions, "ticket_no", "action_taken_by") == [("T1", "u"), ("T1", "v")]
    attempts = frame(spark, "ticket_no string", ("T1",), ("T2",))
    weekly.record_requests(tables["ticket_tracking"], attempts, actions, tracking.TICKET_KEYS, NOW)
    assert values(tables["ticket_tracking"].read(), "ticket_no", "last_successful_fetch", "records_count", "failure_count") == sorted([
        ("T1", ts(NOW), 2, 0), ("T2", None, None, 1)], key=repr)
    assert values(weekly.plan_action_requests(tables, NOW), "ticket_no") == ["T2"]


def test_publish_reports(spark, tmp_path):
    from helpers import tickets

    rows = tickets(spark, [{"category": "General", "dept": "D", "complaint_text": "x"}])
    folders = weekly.publish_reports(rows, "2025-06-22", str(tmp_path / "reports"))
    assert spark.read.parquet(folders["overall_stats"]).where(F.col("office") == "A").count() == 1
    assert len(folders) == 17
