from helpers import bag, frame, plans_sorted, ts, values
from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.operators import documents, lookup, merge, tracking

D = "dist_id int, dist_name string"
DB = D + ", ingest_seq int"
DOCS = ("ticket_no string, document_url string, local_document_path string, document_downloaded boolean, "
        "document_download_date timestamp, document_download_error string")
UPDATE = "ticket_no string, local_path string, success boolean, error string, attempt_seq int"
ACTION = ("ticket_no string, action_taken_by string, action_taken_date timestamp_ntz, action_taken_remark string, "
          "action_status string, complaint_status_with_authority string")


def settled(merged):
    """The next table: a merge result without its action column."""
    return merged.drop("action")


# --- districts ---


def test_merge_districts(spark):
    stored = frame(spark, D, (1, "A"), (2, "B"), (3, "C"))
    batch = frame(spark, DB, (1, "A2", 1), (1, "A3", 2), (2, "B", 3), (4, "D", 4))
    merged = merge.merge_districts(stored, batch)
    assert values(merged, "dist_id", "dist_name", "action") == [
        (1, "A3", "update"), (2, "B", "noop"), (3, "C", "kept"), (4, "D", "insert")]
    again = merge.merge_districts(settled(merged), batch)
    assert bag(settled(again)) == bag(settled(merged))
    assert merge.changed(again).count() == 0


def test_load_districts_rename_rules(spark):
    stored = frame(spark, D, (1, "A"))
    plain = frame(spark, DB, (1, "A2", 1), (4, "D", 2))
    repeated = frame(spark, DB, (1, "A2", 1), (4, "D", 2), (4, "D2", 3))
    known_repeated = frame(spark, DB, (1, "A2", 1), (1, "A3", 2), (4, "D", 3))
    assert values(merge.load_districts(stored, plain), "dist_id", "dist_name") == [(1, "A"), (4, "D")]
    assert values(merge.load_districts(stored, repeated), "dist_id", "dist_name") == [(1, "A2"), (4, "D2")]
    assert values(merge.load_districts(stored, known_repeated), "dist_id", "dist_name") == [(1, "A"), (4, "D")]
    assert values(merge.load_districts(stored, plain, rename="always"), "dist_id", "dist_name") == [(1, "A2"), (4, "D")]
    assert values(merge.load_districts(stored, repeated, rename="never"), "dist_id", "dist_name") == [(1, "A"), (4, "D2")]


# --- complaints ---


def _complaints(spark, *rows):
    """(ticket, status, block) rows padded to the complaint table."""
    table = frame(spark, "ticket_no string, status string, block string", *rows)
    for field in C.COMPLAINT_SCHEMA.fields:
        if field.name not in table.columns:
            value = F.lit("kept.pdf") if field.name == "local_document_path" else F.lit(None)
            table = table.withColumn(field.name, value.cast(field.dataType))
    return table.withColumn("document_downloaded", F.lit(True)).select(*C.COMPLAINT_SCHEMA.fieldNames())


def _batch(spark, *rows):
    seq = {r[0] + str(r[1]): i for i, r in enumerate(rows)}
    table = _complaints(spark, *rows).select(*[f.name for f in C.COMPLAINT_FIELDS])
    return table.withColumn("ingest_seq", F.element_at(
        F.create_map(*[F.lit(x) for kv in seq.items() for x in kv]), F.concat("ticket_no", "status")))


def test_merge_complaints(spark):
    stored = _complaints(spark, ("T1", "new", "b"), ("T2", "new", "b"), ("T3", "new", None))
    batch = _batch(spark, ("T1", "old", "b"), ("T1", "done", None), ("T3", "new", None), ("T4", "new", None))
    merged = merge.merge_complaints(stored, batch)
    assert values(merged, "ticket_no", "status", "block", "local_document_path", "document_downloaded", "action") == sorted([
        ("T1", "done", None, "kept.pdf", True, "update"), ("T2", "new", "b", "kept.pdf", True, "kept"),
        ("T3", "new", None, "kept.pdf", True, "noop"), ("T4", "new", None, None, False, "insert")], key=repr)
    assert values(merge.changed(merged), "ticket_no") == ["T1", "T4"]
    assert bag(merge.changed_complaints(stored, batch)) == bag(merge.changed(merged))
    again = merge.merge_complaints(settled(merged), batch)
    assert bag(settled(again)) == bag(settled(merged)) and merge.changed(again).count() == 0
    shuffled = merge.merge_complaints(stored.orderBy(F.rand(1)), batch.repartition(3).orderBy(F.rand(2)))
    assert bag(shuffled) == bag(merged)


def test_merge_moves_no_texts_that_are_not_selected(spark):
    stored = _complaints(spark, ("T1", "new", "b"), ("T2", "new", None), ("T3", None, "b"))
    batch = _batch(spark, ("T1", "new", "b"), ("T2", "new", None), ("T3", "b", None))
    action = merge.merge_complaints(stored, batch).select("ticket_no", "action")
    assert values(action, "ticket_no", "action") == [("T1", "noop"), ("T2", "noop"), ("T3", "update")]
    node = action._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    assert "complaint_text" not in node.output().mkString(" ")


def test_dedupe_is_combined_before_the_shuffle(spark):
    plan = merge.last_in_batch(_batch(spark, ("T1", "a", None), ("T1", "b", None)), ["ticket_no"], "ingest_seq")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in text


# --- actions ---


def _action(ticket, by, date, remark="r", status="Forward", seen="Open"):
    return (ticket, by, ts(date), remark, status, seen)


def _with_seq(spark, *rows):
    return frame(spark, ACTION + ", ingest_seq int", *[(*r, i) for i, r in enumerate(rows)])


def test_append_actions_first_wins(spark):
    stored = frame(spark, ACTION, _action("T1", "u", "2025-01-01"))
    batch = _with_seq(spark, _action("T1", "u", "2025-02-02"), _action("T1", "v", "2025-01-01"),
                      _action("T1", "v", "2025-01-05"), _action("T2", "u", None))
    merged = merge.append_actions(stored, batch)
    assert values(merged, "ticket_no", "action_taken_by", "action_taken_date", "action") == sorted([
        ("T1", "u", ts("2025-01-01"), "kept"), ("T1", "v", ts("2025-01-01"), "insert"), ("T2", "u", None, "insert")], key=repr)


def test_load_actions(spark):
    stored = frame(spark, ACTION, _action("T1", "u", "2025-01-01"), _action("T1", "v", "2025-01-02"),
                   _action("T1", "w", "2025-01-02"), _action("T2", "u", None))
    batch = _with_seq(
        spark,
        _action("T1", "u", "2025-01-01", remark="changed"),  # replaces the only row of its date
        _action("T1", "x", "2025-01-02"),  # the date is shared by two stored rows
        _action("T2", "u", None),  # known
        _action("T2", "u", None, remark="other"),  # no date: inserted
        _action("T3", "u", "2025-03-01"), _action("T3", "v", "2025-03-01"),  # same date, both load
        _action("T1", "w", "2025-06-06"),  # known key under another date: skipped
    )
    merged = merge.load_actions(stored, batch)
    assert values(merged, "ticket_no", "action_taken_by", "action_taken_remark", "action") == sorted([
        ("T1", "u", "changed", "update"), ("T1", "v", "r", "kept"), ("T1", "w", "r", "kept"), ("T1", "x", "r", "insert"),
        ("T2", "u", "r", "kept"), ("T2", "u", "other", "insert"), ("T3", "u", "r", "insert"), ("T3", "v", "r", "insert"),
    ], key=repr)
    again = merge.load_actions(settled(merged), batch)
    assert bag(settled(again)) == bag(settled(merged)) and merge.changed(again).count() == 0
    assert merge.load_actions(stored, batch.limit(0)).count() == 4


# --- lookups ---


def test_without_documents(spark):
    rows = frame(spark, DOCS, ("T1", "http://a", None, False, None, None), ("T2", "", None, False, None, None),
                 ("T3", None, None, False, None, None), ("T4", "N/A", None, False, None, None),
                 ("T5", "http://b", None, True, None, None), ("T6", "http://c", None, False, None, "boom"),
                 ("T7", "http://d", None, None, None, None))
    assert values(lookup.without_documents(rows), "ticket_no") == ["T1"]
    assert values(lookup.without_documents(rows, failed_before=True), "ticket_no") == ["T6"]
    assert values(lookup.with_document_urls(rows), "ticket_no") == ["T1", "T3", "T4", "T5", "T6", "T7"]


def test_simple_lookups(spark):
    rows = frame(spark, D, (1, "A"), (2, "a"))
    assert values(lookup.district_by_id(rows, 2), "dist_name") == ["a"]
    assert values(lookup.district_by_name(rows, "A"), "dist_id") == [1]
    assert lookup.district_by_id(rows, 9).count() == 0
    assert lookup.renamed(rows, {"dist_name": "n"}, suffix="_x", keep=["dist_id"]).columns == ["dist_id", "n_x"]


# --- tracking ---

TRACK = "ticket_no string, last_successful_fetch timestamp_ntz, records_count bigint, failure_count bigint"
NOW = "2025-07-01 12:00:00"


def test_tickets_to_fetch(spark):
    tickets = frame(spark, "ticket_no string", ("T456",), ("T123",), ("T101",), ("T7",), ("T8",), ("T9",))
    tracked = frame(
        spark, TRACK, ("T123", ts("2025-06-30"), 3, 0), ("T101", ts("2025-06-20"), 3, 0),
        ("T7", ts("2025-06-20"), 3, 5), ("T8", None, None, 3), ("T9", None, None, 2))
    assert values(tracking.tickets_to_fetch(tickets, tracked, NOW), "ticket_no") == ["T101", "T456", "T9"]


CELL = "year int, dist_id int, status int, office int"


def test_cells_to_fetch(spark):
    grid = frame(spark, CELL, *[(2024, d, 0, 1) for d in range(1, 7)])
    tracked = frame(
        spark, CELL + ", last_successful_fetch timestamp_ntz, records_count bigint, failure_count bigint",
        (2024, 1, 0, 1, ts("2025-06-21"), 5, 0), (2024, 2, 0, 1, None, None, 4), (2024, 3, 0, 1, None, None, 2),
        (2024, 4, 0, 1, ts("2025-06-24 12:00:00"), 5, 0), (2024, 5, 0, 1, ts("2025-06-24 11:59:59"), 5, 0))
    assert values(tracking.cells_to_fetch(grid, tracked, NOW), "dist_id") == [1, 3, 5, 6]
    assert values(tracking.cells_to_fetch(grid, tracked, NOW, days=15), "dist_id") == [3, 6]
    forced = frame(spark, CELL, (2024, 6, 0, 1))
    assert tracking.with_forced_cells(tracking.cells_to_fetch(grid, tracked, NOW), forced).count() == 5


def test_request_grid(spark):
    grid = tracking.request_grid(frame(spark, D, (1, "A"), (2, "B")), [2024])
    assert grid.count() == 2 * 3 * 7 == grid.distinct().count()


def test_recording(spark):
    keys = tracking.TICKET_KEYS
    tracked = frame(spark, TRACK, ("T1", ts("2025-06-01"), 3, 0), ("T2", None, None, 2))
    failed = tracking.record_failures(tracked, frame(spark, "ticket_no string", ("T1",), ("T3",), ("T3",)), keys)
    assert values(failed, *tracked.columns) == sorted([
        ("T1", ts("2025-06-01"), 3, 1), ("T2", None, None, 2), ("T3", None, None, 2)], key=repr)
    won = tracking.record_successes(failed, frame(spark, "ticket_no string, records bigint", ("T2", 9), ("T4", 1)), keys, NOW)
    assert values(won, *tracked.columns) == sorted([
        ("T1", ts("2025-06-01"), 3, 1), ("T2", ts(NOW), 9, 0), ("T3", None, None, 2), ("T4", ts(NOW), 1, 0)], key=repr)
    outcomes = frame(spark, "ticket_no string, outcome string, records bigint, attempt_seq int",
                     ("T1", "failure", 0, 1), ("T1", "success", 8, 2), ("T1", "failure", 0, 3), ("T3", "failure", 0, 4))
    both = tracking.record_outcomes(won, outcomes, keys, NOW)
    assert values(both.where("ticket_no IN ('T1', 'T3')"), "last_successful_fetch", "records_count", "failure_count") == sorted([
        (ts(NOW), 8, 1), (None, None, 3)], key=repr)


def test_fold_outcomes(spark):
    attempts = frame(spark, CELL + ", failed boolean", (2024, 1, 0, 1, False), (2024, 2, 0, 1, True), (2024, 3, 0, 1, False))
    landed = frame(spark, CELL, (2024, 1, 0, 1), (2024, 1, 0, 1))
    folded = tracking.fold_outcomes(attempts, landed, tracking.CELL_KEYS)
    assert values(folded, "dist_id", "outcome", "records") == [(1, "success", 2), (2, "failure", 0), (3, "failure", 0)]
    lenient = tracking.fold_outcomes(attempts, landed, tracking.CELL_KEYS, empty_is_success=True)
    assert values(lenient, "dist_id", "outcome") == [(1, "success"), (2, "failure"), (3, "success")]
    assert tuple(tracking.outcome_totals(folded).first()) == (1, 2)


# --- documents ---


def test_document_updates(spark):
    rows = frame(spark, DOCS, *[(f"T{i}", "http://a", "old.pdf", True, ts("2025-01-01"), None) for i in range(1, 6)])
    updates = frame(spark, UPDATE, ("T1", "new.pdf", True, None, 1), ("T1", None, False, "late", 2),
                    ("T2", None, False, "boom", 3), ("T3", None, False, None, 4), ("T9", "x", True, None, 5))
    columns = ("ticket_no", "local_document_path", "document_downloaded", "document_download_date", "document_download_error")
    old = ts("2025-01-01")
    want = [("T1", "new.pdf", True, ts(NOW), None), ("T2", None, False, old, "boom"), ("T3", None, False, old, None),
            ("T4", "old.pdf", True, old, None), ("T5", "old.pdf", True, old, None)]
    assert values(documents.apply_updates(rows, updates, NOW), *columns) == want
    want[2] = ("T3", "old.pdf", True, old, None)
    assert values(documents.apply_updates(rows, updates, NOW, skip_clears=False), *columns) == want
    one = documents.update_status(rows, "T2", None, False, NOW, "gone")
    assert values(one.where("ticket_no = 'T2'"), *columns) == [("T2", None, False, ts(NOW), "gone")]
    assert bag(documents.update_status(rows, "T99", None, False, NOW)) == bag(rows)


def test_attempts(spark):
    attempts = frame(spark, "ticket_no string, local_path string, error string, attempt_seq int",
                     ("T1", "p", None, 1), ("T1", None, "e", 2), ("T2", None, None, 1))
    assert values(documents.last_statuses(attempts), "ticket_no", "status") == [("T1", "failed"), ("T2", "skipped")]
    assert values(documents.updates_from_attempts(attempts), "ticket_no", "local_path", "success", "error") == sorted([
        ("T1", "p", True, None), ("T1", None, False, "e"), ("T2", None, False, None)], key=repr)


def test_download_plan_and_pending(spark):
    rows = frame(spark, DOCS, *[(f"GOV{i}", u, None, False, None, None) for i, u in enumerate(
        ["http://a~pdf", "http://b~pdf", "www.c~pdf", "http://d", "http://e~PDF", ""])])
    stored = frame(spark, "name string", ("GOV1_complaint_20240702_1.pdf",), ("GOV3_other_20240702_1.bin",),
                   ("GOV4_complaint_20240702_1.PDF",), ("junk",))
    plan = documents.download_plan(rows, stored, NOW)
    assert values(plan, "ticket_no", "document_name") == [
        ("GOV0", "GOV0_complaint_20250701_120000.pdf"), ("GOV3", "GOV3_complaint_20250701_120000.bin"),
        ("GOV4", "GOV4_complaint_20250701_120000.pdf")]
    assert values(documents.download_plan(rows, stored, NOW, any_case=True), "ticket_no") == ["GOV0", "GOV3"]
    assert values(documents.already_stored(rows, stored), "ticket_no") == ["GOV1"]
    assert values(documents.pending_tickets(rows, stored), "ticket_no") == ["GOV0", "GOV2"]
    assert values(documents.first_pending(documents.pending_tickets(rows, stored), 1), "ticket_no") == ["GOV0"]


def test_hot_cell_is_spread(spark):
    """A third of all attempts are on one cell; no task of the fold sees more than a salt of them."""
    attempts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 500).cast("int").alias("k"),
        F.when(F.col("id") == 1500, "success").otherwise("failure").alias("outcome"),
        F.lit(5).cast("long").alias("records"), F.col("id").cast("int").alias("attempt_seq"))
    empty = frame(spark, "k int, last_successful_fetch timestamp_ntz, records_count long, failure_count long")
    got = {r["k"]: (r["records_count"], r["failure_count"]) for r in tracking.record_outcomes(empty, attempts, ["k"], NOW).collect()}
    assert got[7] == (5, 499) and len(got) == 501 and sum(n for _, n in got.values()) == 2999 - 500
    plan = plans_sorted(tracking.record_outcomes(empty, attempts, ["k"], NOW))
    scans = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Attempts move by (key, salt), or combined by key.
    assert sum("_salt" in line for line in scans) >= 2
    spread = attempts.where("outcome = 'failure' AND k = 7").select(F.pmod(F.xxhash64("attempt_seq", "records"), F.lit(16)).alias("s"))
    assert spread.groupBy("s").count().agg(F.max("count")).first()[0] < 3 * 1000 / 16


def test_load_actions_leaves_other_tickets_alone(spark):
    stored = frame(spark, ACTION, ("T1", "u", ts("2025-01-01"), "r", "Forward", "Open"), (None, "u", None, "n", "Forward", "Open"),
                   ("T2", "u", ts("2025-01-01"), "r", "Forward", "Open"))
    batch = frame(spark, ACTION + ", ingest_seq int", ("T2", "u", ts("2025-01-01"), "s", "Forward", "Open", 1),
                  (None, "u", None, "n", "Forward", "Open", 2))
    got = values(merge.load_actions(stored, batch), "ticket_no", "action_taken_remark", "action")
    assert got == [("T1", "r", "kept"), ("T2", "s", "update"), (None, "n", "kept")]
    assert values(merge.action_changes(stored, batch), "ticket_no", "gone") == [("T2", False), ("T2", True)]
