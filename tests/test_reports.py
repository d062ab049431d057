import random
import re

from helpers import bag, frame, plans_sorted, tickets, ts, values
from pyspark.sql import functions as F

from casewright.operators import actions, profile, report_cube, reports

AS_OF = "2025-06-22"


def test_analysis_table_keeps_the_earliest_row(spark):
    short = frame(spark, "ticket_no string, office string, created_on timestamp_ntz",
                  ("T1", "Supertendent of Police", ts("2025-01-01")), ("T2", "B", None))
    full = frame(spark, "ticket_no string, office string, created_on timestamp_ntz, escalation_date timestamp_ntz, resolved_on timestamp_ntz",
                 ("T1", "X", ts("2025-01-01"), ts("2025-02-01"), None), ("T2", "B", ts("2025-05-05"), None, None))
    table = reports.analysis_table({0: short, 2: full})
    assert values(table, "ticket_no", "office", "status_id") == [("T1", "X", 2), ("T2", "B", 2)]
    assert values(reports.analysis_table({0: short}), "office") == ["B", "Superintendent of Police"]


def test_overall_stats_keeps_missing_cells_null(spark):
    rows = tickets(spark, [{"status_id": 0}, {"status_id": 2}, {"status_id": 2}, {"office": "B", "status_id": 1}, {"office": None}])
    assert [tuple(r) for r in reports.overall_stats(rows).collect()] == [
        ("A", 3, 1, None, 2, 33.3, None, 66.7), ("B", 1, None, 1, None, None, 100.0, None)]


def test_time_metrics_and_anchor(spark):
    rows = tickets(spark, [
        {"created_on": "2025-01-01 12:00:00", "resolved_on": "2025-01-03", "benefitted": "Yes"},
        {"created_on": "2025-01-01", "resolved_on": "2025-01-05", "benefitted": "No"},
        {"status_id": 1, "created_on": "2025-06-21 10:00:00"}, {"status_id": 0, "created_on": "2025-06-20 10:00:00"},
        {"office": "B", "status_id": 1, "created_on": "2025-06-21"},
    ])
    assert [tuple(r) for r in reports.avg_time_metrics(rows, AS_OF).collect()] == [("A", 2.0, 1.0, 1.0, 2.0)]
    assert reports.avg_time_metrics(rows, AS_OF, anchor=None).count() == 2
    assert reports.avg_time_metrics(rows, AS_OF, round_early=True).columns[1] == "avg_avg_days_to_dispose"


def test_status2_stats(spark):
    rows = tickets(spark, [
        {"resolved_on": "2025-01-03", "benefitted": "Yes"}, {"resolved_on": "2025-01-05", "benefitted": "No"},
        {"resolved_on": "2025-01-04", "benefitted": "yes"}, {"office": "B"}])
    assert [tuple(r) for r in reports.status2_stats(rows).collect()] == [
        ("A", 2, 1, 1, 50.0, 50.0, 3.0, 2.0), ("B", 0, 0, 0, 0.0, 0.0, 0.0, 0.0)]
    assert [tuple(r) for r in reports.days_by_benefit(rows).collect()] == [("No", 4.0), ("Yes", 2.0), ("yes", 3.0)]
    assert [tuple(r) for r in reports.benefit_by_mode(rows).collect()] == [("Website", 4, 1, 25.0)]
    assert reports.slow_tail(rows, 3).count() == 1


def test_shares_sum_over_all_groups(spark):
    rows = tickets(spark, [{"category": c} for c in ("General", "Miscellaneous", "Land", None)])
    assert [tuple(r) for r in reports.category_overview(rows).collect()] == [("General & Misc", 2, 66.7), ("Land", 1, 33.3)]
    assert [tuple(r) for r in reports.channel_overview(rows, "online", "category").collect()] == [
        ("General & Misc", 2, 50.0), ("Land", 1, 25.0), (None, 1, 25.0)]
    assert reports.share(rows, "category", None).first()["percent"] == 1 / 3 * 100


def test_topic_reports(spark):
    rows = tickets(spark, [
        {"category": "Social Welfare", "dept": "D", "complaint_text": "New house"},
        {"category": "Social Welfare", "dept": "D", "complaint_text": "my land"},
        {"category": "Social Welfare", "dept": "D", "complaint_text": "ଆର୍ଥିକ house"},
        {"category": "Social Welfare", "dept": "E", "complaint_text": "ration card", "subcategory": None}])
    assert values(reports.topic_mix(rows, "Social Welfare", "D"), "topic", "count", "percent") == [
        ("Housing", 1, 50.0), ("Other", 1, 50.0)]
    assert reports.topic_mentions(rows, "Other", "D", "land").first()[0] == 1
    assert reports.topic_outside_subcategory(rows, "Ration Card", "Ration Card Issue").count() == 1


def test_channel_reports(spark):
    rows = tickets(spark, [
        {"created_on": "2025-06-20", "resolved_on": "2025-06-21", "benefitted": "Yes"},
        {"created_on": "2025-06-20 12:00:00"}, {"mode": "Physical", "created_on": "2025-06-12"},
        {"mode": "Phone"}, {"office": "B", "mode": "Email"}])
    assert [tuple(r) for r in reports.resolution_times(rows, AS_OF).collect()] == [("A", 1, 10, 0, 1, 0, 0)]
    assert reports.resolution_times(rows, AS_OF, anchor=None).count() == 2
    table = {r[0]: tuple(r)[1:] for r in reports.mode_summary_table(rows.where("mode <> 'Email'"), AS_OF).collect()}
    assert table == {"online": (2, 1, 50.0, 1.0, 1.0), "offline": (1, 0, 0.0, None, 10.0), "freetext": (0, 0, 0.0, None, None)}
    assert values(reports.office_mode_shares(rows), "office", "mode", "count", "percent") == [
        ("A", "Phone", 1, 25.0), ("A", "Physical", 1, 25.0), ("A", "Website", 2, 50.0), ("B", "Email", 1, 100.0)]
    assert [r.asDict() for r in reports.office_mode_pct(rows, ["Email", "Phone", "Physical", "Website"]).where("office = 'A'").collect()] == [
        {"office": "A", "Email": 0.0, "Phone": 25.0, "Physical": 25.0, "Website": 50.0}]
    summary = reports.office_channel_summary(rows).collect()
    assert [(r["office"], r["online_count"], r["online_percent"]) for r in summary] == [("A", 2, 66.7), ("B", 0, 0.0)]
    assert [tuple(r) for r in reports.benefitted_pct_by_channel(rows, with_total=True).collect()] == [("A", 1, 100.0, 0.0, 0.0)]


def test_report_catalogue_runs_and_leaves_input_alone(spark):
    rows = tickets(spark, [{"category": "General", "dept": "D", "complaint_text": "x", "resolved_on": "2025-02-01"}])
    before = rows.columns
    for name, report in reports.report_catalogue(rows, AS_OF).items():
        assert report.columns, name
        report.collect()
    assert rows.columns == before and rows.first()["category"] == "General"


def test_text_profiles(spark):
    rows = tickets(spark, [{"complaint_text": "Financial help"}] * 12 + [{"complaint_text": "."}] * 11
                   + [{"complaint_text": "One"}, {"complaint_text": "one"}, {"complaint_text": None}])
    flags = {r["complaint_text"]: (r["count"], r["repeated_text"], r["classified_text"]) for r in profile.text_flags(rows).collect()}
    assert flags == {"Financial help": (12, True, True), ".": (11, True, False), "One": (1, False, False), "one": (1, False, False)}
    assert [tuple(r) for r in profile.repeated_share(rows).collect()] == [("Website", 23, 26, 88.46)]
    assert [tuple(r) for r in profile.classified_share(rows).collect()] == [("Website", 12, 26, 46.15)]
    assert tuple(profile.distinct_text_totals(rows).first()) == (3, 25, 25)
    assert values(profile.mode_texts(rows, "Website", "repeated"), "complaint_text", "count") == [(".", 11), ("financial help", 12), ("one", 2)]
    assert tuple(profile.mode_text_summary(rows).first()) == ("Website", 25, 3, 3, 100.0)


def test_senders(spark):
    rows = tickets(spark, [{"mode": "Whatsapp", "petitioner_mobile": "1", "created_on": f"2025-01-{30 - i}"} for i in range(12)]
                   + [{"mode": "Whatsapp", "petitioner_mobile": "2"}, {"mode": "Whatsapp"}, {"petitioner_mobile": "1"}])
    assert tuple(profile.heavy_senders(rows, "Whatsapp").first()) == (12, 14, 85.7)
    sent = [r["created_on"] for r in profile.repeat_sender_rows(rows.coalesce(1), "Whatsapp").collect()]
    assert len(sent) == 12 and sent == sorted(sent)


def test_profiles(spark):
    rows = frame(spark, "a int, b string", (1, "x y"), (3, None), (None, "z"))
    got = {r["column_name"]: r for r in profile.column_profile(rows).collect()}
    assert (got["a"]["missing"], got["a"]["missing_pct"], got["a"]["mean_value"], got["a"]["max_value"]) == (1, 33.33, 2.0, "3")
    assert (got["b"]["total_words"], got["b"]["column_type"], got["b"]["mean_value"]) == (3, "string", None)
    sketch = {r["column_name"]: r for r in profile.column_sketch(rows).collect()}
    assert sketch["a"]["distinct_values"] == 2 and sketch["a"]["p50"] in (1.0, 3.0) and sketch["b"]["p50"] is None
    assert tuple(profile.shape(rows).first()) == (3, 2)
    assert profile.duplicate_rows(rows.union(rows), "a").first()[0] == 3
    assert profile.missing_where(rows, F.col("a") == 3, "b").first()[0] == 1


ACTIONS = "ticket_no string, action_status string, action_taken_date timestamp_ntz"


def test_action_tokens(spark):
    rows = frame(spark, ACTIONS, *[("T1", "Reminder Sent", None)] * 8, ("T2", "Complaint Register", None),
                 ("T2", "Complaint Assigned", None), ("T2", None, None), ("T3", "Something", None))
    tokens = actions.status_tokens(rows)
    assert values(tokens, "ticket_no", "Reminder Sent", "Complaint Register") == [("T1", 8, 0), ("T2", 0, 1), ("T3", 0, 0)]
    totals = actions.token_totals(tokens).first().asDict()
    assert totals["tickets"] == 1 and totals["Complaint Assigned"] == 1 and totals["Reminder Sent"] == 0
    assert values(actions.token_sum_distribution(rows), "sum", "count") == [(0, 1), (2, 1), (8, 1)]
    assert actions.busy_ticket_actions(rows).count() == 8
    assert actions.flagged(rows, "Reminder Sent").count() == 8
    assert actions.with_status_flags(rows).where("ticket_no = 'T2'").where(~F.col("Replied")).count() == 3
    listed = frame(spark, "ticket_no string", ("T2",), ("T2",), (None,))
    assert actions.actions_for(rows, listed).count() == 3


def test_forwarding_times(spark):
    rows = frame(spark, ACTIONS, ("T1", "Complaint Register", ts("2025-01-01")), ("T1", "Forward", ts("2025-01-02")),
                 ("T1", "Replied", ts("2025-01-05")), ("T2", "Forward", ts("2025-01-01")), ("T3", "Replied", None))
    assert values(actions.forwarding_times(rows), "ticket_no", "total_days_diff", "days_to_fw", "potential_savings") == [
        ("T1", 4.0, 1.0, 25.0), ("T2", 0.0, 0.0, None), ("T3", None, None, None)]


def test_cube_reports_equal_direct_ones(spark, tmp_path):
    """Every published report from one cube, nulls in every column included."""
    rng = random.Random(1)

    def pick(*values):
        return rng.choice(values)

    rows = []
    for _ in range(400):
        created = f"2025-0{rng.randrange(1, 6)}-{rng.randrange(10, 28)} 0{rng.randrange(10)}:10:00"
        resolved = pick(None, f"2025-0{rng.randrange(5, 9)}-11 11:00:00")
        rows.append({
            "office": pick("A", "B", "Only Letters", None), "mode": pick("Website", "Letter", "Physical", "Other", None),
            "status_id": pick(0, 1, 2, 2, None), "benefitted": pick("Yes", "No", "yes", None), "created_on": pick(created, created, None),
            "resolved_on": resolved, "dept": pick(report_cube.TOPIC_DEPT, "D2", None),
            "category": pick("General", "Miscellaneous", report_cube.TOPIC_CATEGORY, report_cube.TOPIC_CATEGORY, None),
            "complaint_text": pick("water pipe broken", "pension not paid", "\u0b28\u0b2e\u0b38\u0b4d", None, "")})
    for given in (rows, rows[:1], []):
        facts = tickets(spark, given)
        facts.write.mode("overwrite").parquet(str(tmp_path / "facts"))
        stored = spark.read.parquet(str(tmp_path / "facts"))
        report_cube.cube(stored, AS_OF).write.mode("overwrite").parquet(str(tmp_path / "cube"))
        cut = report_cube.report_catalogue(spark.read.parquet(str(tmp_path / "cube")))
        direct = reports.report_catalogue(stored, AS_OF)
        assert list(cut) == list(direct)
        for name, want in direct.items():
            assert cut[name].dtypes == want.dtypes, name
            assert [tuple(r) for r in cut[name].collect()] == [tuple(r) for r in want.collect()] or name == "office_mode_shares", name
            assert bag(cut[name]) == bag(want), name


def test_cube_scans_the_facts_once(spark, tmp_path):
    tickets(spark, [{}]).write.parquet(str(tmp_path / "facts"))
    plan = plans_sorted(report_cube.cube(spark.read.parquet(str(tmp_path / "facts")), AS_OF))
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and len(re.findall(r"\bExchange\b", plan)) == 1


def test_texts_are_added_to_counted_groups(spark):
    said = ["Long text number one"] * 12 + ["long text number ONE"] * 2 + ["short", None, ""]
    rows = tickets(spark, [{"complaint_text": t, "mode": "Letter" if i % 5 == 0 else "Phone"} for i, t in enumerate(said)])
    texts = lambda found: found.join(rows.select("ticket_no", "complaint_text"), "ticket_no")
    for f in (profile.text_flags, profile.distinct_texts, profile.text_counts):
        assert bag(f(rows, texts=texts)) == bag(f(rows))
    node = profile.text_flags(rows, texts=lambda found: found.withColumn("complaint_text", F.lit("t")))._jdf.queryExecution()
    assert "complaint_text" not in node.optimizedPlan().toString().split("Aggregate")[1].split("\n")[0].split("AS length")[1]
