import json
import re

import pytest
from helpers import bag, complaint, envelope, frame, plans_sorted, ts, values

from pyspark.sql import functions as F, types as T

from casewright import contracts as C
from casewright.operators import conform, documents, merge, quality
from casewright.plans import weekly
from casewright.sources import column_json, landing, listing, tables, ticket_lists
from casewright.streaming import ingest


def records(spark, *texts):
    rows = frame(spark, "n int, value string", *enumerate(texts))
    return landing.unwrap_envelopes(rows)


def checked(spark, *items):
    return conform.conform_complaints(records(spark, envelope(*items)).records)


def problems(spark, **changes):
    rejects = checked(spark, complaint(**changes)).rejects.collect()
    return sorted(rejects[0]["errors"]) if rejects else []


# --- envelopes ---


def test_envelopes(spark):
    got = records(
        spark, envelope({"a": 1}, {"a": 2}), envelope({"a": 3}, key="distRes"),
        envelope({"a": 4}, key="actionHistory"), json.dumps({"status": 204}), envelope({"a": 5}, status=400),
        json.dumps({"status": 200}), "no json", json.dumps({"status": 200, "distRes": None, "Res": [{"a": 6}]}),
        json.dumps({"status": 200, "Res": {"a": 7}}), json.dumps({"status": "200", "Res": [{"a": 8}]}),
        json.dumps({"status": 200, "Res": []}),
    )
    assert [(r["n"], r["pos"]) for r in got.records.orderBy("n", "pos").collect()] == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert values(got.rejects, "n", "reason") == sorted([
        (4, "error_status"), (5, "no_payload"), (6, "not_json"), (8, "not_a_list"), (9, "error_status"),
    ], key=repr)


def test_payloads_are_opened_once(spark):
    got = records(spark, envelope({"a": 1}, None, [2]), json.dumps({"status": 200, "Res": None, "actionHistory": "x"}),
                  json.dumps({"status": 200, "distRes": 7, "Res": [{"a": 6}]}), "[1]", "null", json.dumps({"status": 204, "Res": 1}))
    read = got.records.select("n", "pos", F.to_json("record").alias("record"))
    assert values(read, "n", "pos", "record") == [(0, 0, '{"a":1}'), (0, 1, "null"), (0, 2, "[2]")]
    assert values(got.rejects, "n", "reason") == [(2, "not_a_list"), (3, "error_status"), (4, "error_status")]
    plan = got.records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schema_of_variant") + plan.count("schemaOfVariant") <= 1  # of the status only


def test_errors_alone_read_no_texts(spark):
    rejects = checked(spark, complaint(modeName=5), complaint(modeName=None)).rejects.select("errors")
    assert [r["errors"] for r in rejects.collect()] == [["mode:not_text"]] * 2
    assert "_text_complaint_text" not in rejects._jdf.queryExecution().optimizedPlan().toString()


def test_partitioned_landing_prunes(spark, tmp_path):
    rows = frame(spark, "value string, year int, dist_id int, status int, office int",
                 (envelope({"a": 1}), 2024, 1, 0, 3), (envelope({"a": 2}), 2024, 2, 1, 3))
    landing.write_envelopes(rows, str(tmp_path / "land"), C.CELL_KEYS)
    back = landing.read_envelopes(spark, str(tmp_path / "land"), partitioned=True)
    assert back.count() == 2
    cell = back.where("dist_id = 2 AND status = 1")
    assert cell.count() == 1
    assert len(cell.inputFiles()) == 2 and "PartitionFilters: [isnotnull(dist_id" in (
        cell._jdf.queryExecution().executedPlan().toString()
    )


def test_column_oriented_json(spark, tmp_path):
    (tmp_path / "s0.json").write_text(json.dumps({
        "ticket_no": {"0": "T1", "1": "T2"}, "created_on": {"0": 1735689600000, "1": None}, "extra": {"0": 1},
    }))
    (tmp_path / "s2.json").write_text(json.dumps({"ticket_no": {"0": "T3"}, "resolved_on": {"0": 1735689600000}}))
    got = column_json.read_status_files(
        spark, {0: str(tmp_path / "s0.json"), 2: str(tmp_path / "s2.json")},
        ["ticket_no", "created_on", "resolved_on"], ["created_on", "resolved_on"],
    )
    assert values(got, "ticket_no", "status_id", "created_on", "resolved_on") == sorted([
        ("T1", 0, ts("2025-01-01"), None), ("T2", 0, None, None), ("T3", 2, None, ts("2025-01-01")),
    ], key=repr)


def test_ticket_dictionary(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"A": {"Yes": ["T2", "T1"], "No": ["T3"]}, "B": {"Yes": ["T4"]}}))
    lists = ticket_lists.read_ticket_lists(spark, str(tmp_path / "d.json"))
    assert values(ticket_lists.ticket_list(lists, "A", "Yes"), "ticket_no") == ["T1", "T2"]
    assert values(ticket_lists.ticket_list(lists, "A", "Yes", first=1), "ticket_no") == ["T1"]


def test_object_listing(spark, tmp_path):
    for name in ("T1_complaint_1.pdf", "T1_other_1.pdf", "T2_complaint_1.bin"):
        (tmp_path / name).write_text("xyz")
    assert values(listing.list_objects(spark, str(tmp_path)), "name", "length") == [
        ("T1_complaint_1.pdf", 3), ("T1_other_1.pdf", 3), ("T2_complaint_1.bin", 3)]
    assert values(listing.list_objects(spark, str(tmp_path), prefix="T1_"), "name") == [
        "T1_complaint_1.pdf", "T1_other_1.pdf"]
    assert values(listing.list_objects(spark, str(tmp_path), max_keys=1), "name") == ["T1_complaint_1.pdf"]


def test_json_and_report_sinks(spark, tmp_path):
    rows = frame(spark, "a int, b string", (1, None))
    tables.write_json(rows, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"a":1,"b":null}'
    folders = tables.write_reports({"r": rows}, str(tmp_path / "reports"))
    assert spark.read.parquet(folders["r"]).count() == 1


def test_table_of_changes(spark, tmp_path):
    table = tables.open_table(spark, str(tmp_path / "t"), "districts")
    assert table.read().count() == 0
    rows = "dist_id int, dist_name string, seq long"
    table.append(frame(spark, rows, (1, "A", 1), (2, "B", 2)), "s", 0, "seq")
    table.append(frame(spark, rows, (2, "C", 3)), "other", 0, "seq")  # same batch number, another source
    assert values(table.read(), "dist_id", "dist_name") == [(1, "A"), (2, "C")]
    for _ in range(2):  # a replay writes the same commit again
        table.append(frame(spark, rows, (3, "D", 4), (1, "Z", 0)), "s", 1, "seq")
    assert values(table.read(), "dist_id", "dist_name") == [(1, "A"), (2, "C"), (3, "D")]
    assert values(table.read(without=("s", 1)), "dist_id") == [1, 2]
    table.append(frame(spark, rows, (1, "A", 5)), "s", 2, "seq", gone=F.lit(True))
    assert values(table.read(), "dist_id") == [2, 3]
    assert sorted(f"{p.parent.name} {p.name}" for p in (tmp_path / "t/districts/changes").glob("*/*") if p.is_dir()) == [
        "_source=other _batch=0", "_source=s _batch=0", "_source=s _batch=1", "_source=s _batch=2"]


def test_fold_into_state(spark, tmp_path):
    table, rows = tables.open_table(spark, str(tmp_path), "districts"), "dist_id int, dist_name string, seq long"
    for batch in range(12):  # batch 11 comes after batch 2
        table.append(frame(spark, rows, (batch % 5, f"n{batch}", batch)), "s", batch, "seq", gone=F.lit(batch == 9))
    table.append(frame(spark, rows, (7, "other", 0)), "o", 0, "seq")
    want = [(0, "n10"), (1, "n11"), (2, "n7"), (3, "n8"), (7, "other")]
    assert values(table.read(), "dist_id", "dist_name") == want
    for _ in range(2):
        table.fold(3)
        assert values(table.read(), "dist_id", "dist_name") == want
        # What may be replayed stays apart, and there is one state.
        left = table.changes().select("_source", "_batch").distinct()
        assert values(left, "_source", "_batch") == [("o", "0"), ("s", "11")]
        assert len(list((tmp_path / "districts/state").iterdir())) == 1
    table.append(frame(spark, rows, (4, "late", 8), (2, "new", 20)), "s", 12, "seq")  # 4 left later, at 9
    want = [(0, "n10"), (1, "n11"), (2, "new"), (3, "n8"), (7, "other")]
    assert values(table.read(), "dist_id", "dist_name") == want
    assert values(table.read(without=("s", 12)), "dist_name") == ["n10", "n11", "n7", "n8", "other"]
    # Only changes are shuffled to meet the state; a left-out commit is not even listed.
    assert exchanged(table.read(without=("s", 12))) == {"batch"}
    assert re.search(r"PartitionFilters: \[.*_batch", plans_sorted(table.read(without=("s", 12))))


def test_fold_with_null_keys(spark, tmp_path):
    table = tables.open_table(spark, str(tmp_path), "action_history")
    row = {c: None for c in C.ACTION_SCHEMA.names} | {"ticket_no": "T1", "action_status": "Forward"}
    rows = spark.createDataFrame([(*row.values(), 1)], T.StructType([*C.ACTION_SCHEMA.fields, T.StructField("seq", T.LongType())]))
    table.append(rows, "s", 0, "seq")
    table.append(rows, "s", 1, "seq")
    table.fold()
    table.append(rows, "s", 2, "seq")
    assert table.read().count() == 1


def test_batches_into_buckets_shuffle_only_the_batch(spark, tmp_path):
    rows = spark.range(500).select(F.concat(F.lit("T"), "id").alias("ticket_no"), F.lit("x").alias("status"))
    full = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in C.COMPLAINT_SCHEMA.fields if f.name not in rows.columns])
    stored = tables.store_bucketed(full, str(tmp_path / "stored"), ["ticket_no"])
    batch = full.limit(40).withColumn("status", F.lit("y")).withColumn("ingest_seq", F.lit(1))
    merged = merge.merge_complaints(stored, batch)
    assert exchanged(merged) <= {"batch"} and merged.where("status = 'y'").count() == 40
    updates = frame(spark, "ticket_no string, local_path string, success boolean, error string, attempt_seq int", ("T1", "p", True, None, 1))
    applied = documents.apply_updates(stored, updates, "2025-01-01")
    assert exchanged(applied) <= {"batch"} and applied.where("document_downloaded").count() == 1


def test_buckets_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    keys = F.when(F.col("id") % 50 != 0, F.concat(F.lit("T"), F.col("id") % 60))  # repeated and null keys
    rows = spark.range(0, 400, 1, 4).select(keys.alias("ticket_no"), F.repeat(F.lit("word "), 50).alias("text"), "id")
    for files, tasks in ((1 << 15, {0, 1, 2, 3}), (1, {0, 1, 2, 3, 4})):
        monkeypatch.setattr(tables, "_FILES", files)
        folder = tmp_path / f"stored-{files}"
        stored = tables.store_bucketed(rows, str(folder), ["ticket_no"], 5)
        assert bag(stored) == bag(rows) and exchanged(stored.groupBy("ticket_no").count()) == set()
        parts = [re.match(r"part-(\d+)-.*_(\d+)\.c000\.zstd", f.name) for f in folder.glob("*.parquet")]
        found = [(int(p[1]), int(p[2])) for p in parts]
        # Each task of the rows has files of many buckets, or after a shuffle those of its own bucket only.
        assert {t for t, _ in found} <= tasks and all((t != b) <= (files > 1) for t, b in found)
        assert (len(found) > 5) == (files > 1)


def exchanged(rows):
    """Which scans stand below a shuffle in the plan: bucketed ``state`` or the ``batch``."""
    found, below = set(), None
    for line in plans_sorted(rows).splitlines():
        depth = max(line.find("+- "), line.find(":- "))
        if below is not None and depth <= below:
            below = None
        if below is None and re.search(r"\bExchange\b", line):
            below = depth
        elif below is not None and re.search(r"FileScan|LocalTableScan|ExistingRDD|Range \(", line):
            found.add("state" if "Bucketed: true" in line else "batch")
    return found


# --- conformance ---


def test_valid_complaint_is_typed(spark):
    row = checked(spark, complaint(taggedTo=12, taggedByName={"id": 1}, govtTicket="no")).valid.first()
    assert row["ticket_no"] == "T1" and row["govt_ticket"] is False
    assert row["created_on"] == ts("2025-01-02 03:04:05") and row["resolved_on"] is None
    assert row["tagged_to"] == "12" and row["tagged_by"] == '{"id":1}'


@pytest.mark.parametrize("answer, ok", [("Yes", True), ("yes", True), ("No", True), ("no", True), ("Maybe", False), (None, False)])
def test_yes_no(spark, answer, ok):
    assert problems(spark, govtTicket=answer) == ([] if ok else ["govt_ticket:not_yes_no"])


@pytest.mark.parametrize("changes, want", [
    ({"CreatedOn": "not-a-date"}, ["created_on:not_time"]),
    ({"taggedDate": "not-a-date"}, []),
    ({"assignedOn": None}, ["assigned_on:not_time"]),
    ({"blockName": None}, []),
    ({"blockName": ...}, ["block:missing"]),
    ({"blockName": 5}, ["block:not_text"]),
    ({"taggedTo": ...}, ["tagged_to:missing"]),
    ({"ticketNumber": None}, ["ticket_no:not_text"]),
    ({"modeName": 3, "stateName": ...}, ["mode:not_text", "state:missing"]),
    ({"officeNAme": "Unknown Office"}, ["office:unknown_office"]),
    ({"officeNAme": 5}, ["office:unknown_office"]),
    ({"unknown": 1}, []),
])
def test_field_rules(spark, changes, want):
    assert problems(spark, **changes) == want


def test_one_bad_row_does_not_stop_the_rest(spark):
    result = checked(spark, complaint(), complaint(govtTicket="Maybe"))
    assert result.valid.count() == 1
    assert values(result.rejects, "pos") == [1]


@pytest.mark.parametrize("spelling, office", [
    ("Cheif Minister", "Office of Chief Minister"), ("Supertendent of Police", "Superintendent of Police"),
    ("Collector", "Collector"), ("Dept", None), ("SP", None), ("Unknown Office", None), (None, None),
])
def test_office_spelling(spark, spelling, office):
    rows = frame(spark, "o string", (spelling,))
    assert rows.select(conform.matched_office(rows["o"])).first()[0] == office


def test_districts(spark):
    got = conform.conform_districts(records(spark, envelope(
        {"distId": 1, "distName": "A"}, {"distId": "2", "distName": "B"}, {"distId": "x", "distName": "C"},
        {"distId": 4.0, "distName": "D"}, {"distId": 4.5, "distName": "E"}, {"distName": "F"}, key="distRes",
    )).records)
    assert values(got.valid, "dist_id", "dist_name") == [(1, "A"), (2, "B"), (4, "D")]
    assert values(got.rejects, "pos") == [2, 4, 5]


def test_actions_take_the_request_ticket(spark):
    record = {"ticketNumber": "ZZ", "action_taken_by": "u", "action_taken_date": "05-Jul-2025 03:15 PM",
              "action_taken_remark": "r", "action_status": "Forward", "complaint_status_with_authority": "Open"}
    rows = frame(spark, "request_ticket string, value string",
                 ("T7", envelope(record, {**record, "action_taken_remark": None}, key="actionHistory")))
    got = conform.conform_actions(landing.unwrap_envelopes(rows).records)
    assert values(got.valid, "ticket_no", "action_taken_date") == [("T7", ts("2025-07-05 03:15:00"))]
    assert got.rejects.count() == 1


# --- constraints ---


def test_constraints(spark):
    rows = frame(spark, "k string, v string, status int, office int",
                 ("a", None, 0, 1), ("a", "x", 3, 1), ("b", None, 1, 8), (None, "y", None, 1))
    assert values(quality.null_violations(rows, ["k", "v"]), "column_name", "violations") == [("k", 1), ("v", 2)]
    assert values(quality.unique_violations(rows, ["k"]), "k", "row_count") == [("a", 2)]
    assert values(quality.orphans(rows, frame(spark, "k string", ("b",)), "k"), "k", "row_count") == [("a", 2)]
    assert quality.domain_violations(rows).count() == 3
    filled = quality.with_defaults(rows, {"v": "z", "failure_count": 0})
    assert values(filled, "v", "failure_count") == [("x", 0), ("y", 0), ("z", 0), ("z", 0)]


# --- streaming ---


def _land(folder, name, *envelopes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(
        json.dumps({"value": text, "ingest_seq": seq}) for seq, text in envelopes
    ))


def _stream(spark, kind, land, root, checkpoint):
    ingest.start(spark, kind, str(land), str(root), str(checkpoint), files_per_batch=1).awaitTermination()
    return tables.open_table(spark, str(root), ingest.FEEDS[kind].table)


def test_stream_equals_batch_and_loses_nothing(spark, tmp_path):
    land, root, checkpoint = tmp_path / "landing", tmp_path / "streamed", tmp_path / "checkpoint"
    _land(land, "1.json", (1, envelope(complaint(), complaint(ticketNumber="T2", govtTicket="?"))))
    _land(land, "2.json", (2, envelope(complaint(StatusName="Disposed"), complaint(ticketNumber="T3"))),
          (3, json.dumps({"status": 400})))
    table = _stream(spark, "complaints", land, root, checkpoint)
    assert values(table.read(), "ticket_no", "status") == [("T1", "Disposed"), ("T3", "x")]
    ingest.ingest_once(spark, "complaints", str(land), str(tmp_path / "batched"))
    batched = tables.open_table(spark, str(tmp_path / "batched"), "complaints")
    assert bag(batched.read()) == bag(table.read())
    # Nothing new landed: nothing changes.
    assert bag(_stream(spark, "complaints", land, root, checkpoint).read()) == bag(batched.read())
    # Another writer commits between two batches of the stream; both arrive.
    weekly.record_downloads(table, frame(
        spark, "ticket_no string, local_path string, error string, attempt_seq int", ("T1", "a.pdf", None, 1), ("T9", "b", None, 1)),
        "2025-07-01 12:00:00")
    _land(land, "3.json", (4, envelope(complaint(ticketNumber="T3", StatusName="Disposed"), complaint(ticketNumber="T4"))))
    want = [("T1", "Disposed", "a.pdf"), ("T3", "Disposed", None), ("T4", "x", None)]
    again = _stream(spark, "complaints", land, root, checkpoint)
    assert values(again.read(), "ticket_no", "status", "local_document_path") == want
    # A lost checkpoint reads all files again, as another query, and changes nothing.
    fresh = _stream(spark, "complaints", land, root, tmp_path / "fresh")
    assert values(fresh.read(), "ticket_no", "status", "local_document_path") == want
    for kind, n in (("records", 1), ("envelopes", 1)):
        rejects = spark.read.parquet(str(root / f"_rejects/complaints/{kind}/*/*"))
        assert rejects.count() == 2 * n and rejects.distinct().count() == n  # once per query


def test_complaint_batch_does_not_read_the_table(spark, tmp_path):
    def table():
        raise AssertionError("read")
    batch = frame(spark, "ticket_no string, ingest_seq long", ("T1", 1), ("T1", 2))
    rows, gone = ingest.FEEDS["complaints"].changes(table, batch)
    assert gone is None and values(rows, "ticket_no", "ingest_seq") == [("T1", 2)]


def test_complaints_are_settled_once_and_move_no_texts(spark, tmp_path):
    result = checked(spark, complaint(ticketNumber="T1"), complaint(ticketNumber="T2", govtTicket="Maybe"))
    settled = conform.settled(result, str(tmp_path / "staged"))
    for a, b in ((settled.valid, result.valid), (settled.rejects, result.rejects)):
        assert a.columns == b.columns and bag(a) == bag(b)
    rows = {r["ticket_no"]: r for r in settled.checked.collect()}
    assert set(rows) == {"T1", None} and rows["T1"]["record"] is None and "T2" in rows[None]["record"]
    once, _ = ingest.FEEDS["complaints"].changes(None, settled.valid.withColumn("ingest_seq", F.lit(1)))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()


def test_a_table_reads_the_named_columns_only(spark, tmp_path):
    table = tables.open_table(spark, str(tmp_path), "complaints")
    rows = checked(spark, complaint(ticketNumber="T1"), complaint(ticketNumber="T2")).valid
    for batch in (0, 1, 2):
        table.append(rows, "s", batch, F.lit(batch))
        read = table.read(columns=["ticket_no", "mode", "document_downloaded"])
        assert bag(read) == bag(table.read().select("ticket_no", "mode", "document_downloaded"))
        assert "complaint_text" not in read._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
        if batch == 1:
            table.fold()


def test_stream_of_districts_and_actions(spark, tmp_path):
    _land(tmp_path / "d", "1.json", (1, envelope({"distId": 1, "distName": "A"}, key="distRes")))
    _land(tmp_path / "d", "2.json", (2, envelope({"distId": 1, "distName": "B"}, {"distId": 2, "distName": "C"}, key="distRes")))
    districts = _stream(spark, "districts", tmp_path / "d", tmp_path / "t", tmp_path / "cd")
    assert values(districts.read(), "dist_id", "dist_name") == [(1, "A"), (2, "C")]

    def land_action(name, seq, **changes):
        record = {"action_taken_by": "u", "action_taken_date": "2025-01-01T10:00:00", "action_taken_remark": "r",
                  "action_status": "Forward", "complaint_status_with_authority": "Open", **changes}
        (tmp_path / "a").mkdir(exist_ok=True)
        (tmp_path / "a" / name).write_text(json.dumps({"request_ticket": "T1", "ingest_seq": seq, "value": envelope(record, key="actionHistory")}))

    land_action("1.json", 1)
    assert values(_stream(spark, "actions", tmp_path / "a", tmp_path / "t", tmp_path / "ca").read(), "action_taken_remark") == ["r"]
    land_action("2.json", 2, action_taken_remark="seen")  # shares the date: replaces
    land_action("3.json", 3, action_taken_remark="later", action_taken_date="2025-01-02T10:00:00")
    table = _stream(spark, "actions", tmp_path / "a", tmp_path / "t", tmp_path / "ca")
    assert values(table.read(), "action_taken_remark") == ["later", "seen"]
