import pytest
from helpers import frame, ts, values
from pyspark.sql import functions as F

from casewright.functions import dates, naming, numbers as num, text as tx


def one(spark, column, **columns):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()] or [F.lit(1)])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("text, want", [
    ("2024-06-01", "2024-06-01 00:00:00"), ("20240601", "2024-06-01 00:00:00"),
    ("2024-06-01T10:20:30", "2024-06-01 10:20:30"), ("2024-06-01 10:20", "2024-06-01 10:20:00"),
    ("2024-06-01x10:20:30", "2024-06-01 10:20:30"), ("2024-06-01T10", "2024-06-01 10:00:00"),
    ("2024-06-01T10:20:30.25", "2024-06-01 10:20:30.250"), ("2024-06-01T10:20:30,5", "2024-06-01 10:20:30.5"),
    ("2024-06-01T10:20:30.1234567", "2024-06-01 10:20:30.123456"),
    ("2024-06-01T10:20:30Z", "2024-06-01 10:20:30"), ("2024-06-01T10:20:30+05:30", "2024-06-01 04:50:30"),
    ("2024-06-01T10:20:30-0100", "2024-06-01 11:20:30"), ("2024-6-1T1:2:3", "2024-06-01 01:02:03"),
    ("2024", None), ("2024-6-1", None), ("2024-13-01", None), ("2024-02-30", None), ("not-a-date", None),
    ("", None), ("2024-06-01T", None), ("2024-06-01T25:00:00", None), ("1-6-2024", None),
])
def test_parse_iso(spark, text, want):
    got = one(spark, dates.parse_iso("c"), c=text)
    assert got == ts(want)


@pytest.mark.parametrize("text, plain, fixed", [
    ("05-Jul-2025 03:15 PM", "2025-07-05 03:15:00", "2025-07-05 15:15:00"),
    ("5-jul-2025 15:15 pm", "2025-07-05 15:15:00", "2025-07-05 15:15:00"),
    ("05-Jul-2025 12:05 AM", "2025-07-05 12:05:00", "2025-07-05 00:05:00"),
    ("2025-07-05T01:02:03", "2025-07-05 01:02:03", "2025-07-05 01:02:03"),
    ("05-Foo-2025 03:15 PM", None, None), ("05-Jul-2025", None, None), ("31-Feb-2025 01:00 AM", None, None),
])
def test_parse_action_time(spark, text, plain, fixed):
    assert one(spark, dates.parse_action_time("c"), c=text) == ts(plain)
    assert one(spark, dates.parse_action_time("c", fix_meridiem=True), c=text) == ts(fixed)


def test_days_floor_and_calendar(spark):
    rows = frame(spark, "a timestamp_ntz, b timestamp_ntz",
                 (ts("2024-01-02 12:00:00"), ts("2024-01-01 00:00:00")),
                 (ts("2024-01-01 10:00:00"), ts("2024-01-02 00:00:00")))
    got = rows.select(dates.elapsed_days("a", "b"), dates.calendar_days("a", "b"), dates.fractional_days("a", "b"))
    assert [tuple(r) for r in got.collect()] == [(-2, -1, -1.5), (0, 1, 14 / 24)]


def test_other_dates(spark):
    assert one(spark, dates.from_epoch_millis("c"), c=1735689600123) == ts("2025-01-01 00:00:00.123")
    assert one(spark, dates.days_before("2025-01-08 05:00:00", 7)) == ts("2025-01-01 05:00:00")
    assert one(spark, dates.day_start(dates.ntz("2025-01-08 05:00:00"))) == ts("2025-01-08")
    assert one(spark, dates.local_to_utc(dates.ntz("2025-01-08 05:30:00"), "Asia/Kolkata")) == ts("2025-01-08")
    assert one(spark, dates.weekday_name(dates.ntz("2025-06-22"))) == "Sunday"
    assert one(spark, dates.month_name(dates.ntz("2025-06-22"))) == "June"


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, dates.parse_iso("c"), c="2024-06-01T10:20:30+05:30") == ts("2024-06-01 04:50:30")
        assert one(spark, dates.parse_iso("c"), c="2024-03-10T02:30:00") == ts("2024-03-10 02:30:00")
        assert one(spark, dates.from_epoch_millis("c"), c=1735689600123) == ts("2025-01-01 00:00:00.123")
        assert one(spark, dates.local_to_utc(dates.ntz("2025-01-08 05:30:00"), "Asia/Kolkata")) == ts("2025-01-08")
        days = dates.elapsed_days(dates.ntz("2024-03-10 00:00:00"), dates.ntz("2024-03-11 00:00:00"))
        assert one(spark, days) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rounding_and_division(spark):
    assert one(spark, num.rounded(F.lit(0.25), 1)) == 0.2
    assert one(spark, num.rounded(F.lit(2.5))) == 2.0
    assert one(spark, num.percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, num.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, num.zero_if_null(num.percent(F.lit(1), F.lit(0)))) == 0.0


@pytest.mark.parametrize("text, topic", [
    ("my PMAY house", "Housing"), ("Subhadra Yojana", "Housing"), ("subhadra money", "Subhadra Scheme"),
    ("new Ration Card", "Ration Card"), ("road", "Other"), (None, "Other"),
])
def test_topic(spark, text, topic):
    assert one(spark, tx.topic_of("c"), c=text) == topic


@pytest.mark.parametrize("text, want", [
    ("a" * 9 + "é", True), ("a" * 8 + "éé", False), ("", False), (None, False), ("ଆର୍ଥିକ", False),
])
def test_mostly_ascii(spark, text, want):
    assert one(spark, tx.is_mostly_ascii("c"), c=text) is want


def test_mostly_ascii_between_the_bounds_of_lengths(spark):
    texts = ["a" * (40 - n) + c * n for n in range(41) for c in ("é", "क", "😀")] + ["a" * 36 + "é😀क😀", "a" * 37 + "é😀क"]
    got = frame(spark, "c string", *[(t,) for t in texts]).select(tx.is_mostly_ascii("c")).collect()
    assert [r[0] for r in got] == [sum(c < "\x80" for c in t) / len(t) >= 0.9 for t in texts]
    broken = spark.sql("SELECT CAST(X'61FF' AS STRING) AS c UNION ALL SELECT CAST(X'61616161616161616161C3' AS STRING)")
    assert [r[0] for r in broken.select(tx.is_mostly_ascii("c")).collect()] == [False, True]


def test_filters_on_topics_read_the_text_once(spark):
    rows = frame(spark, "a string, b string", ("my ", "house"), ("a ", "road")).select(F.concat("a", "b").alias("t"))
    picked = rows.where(tx.is_mostly_ascii("t") & (tx.topic_of("t") == "Other"))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count("lower(") == 1 and condition.count("concat(") == 2
    assert [r["t"] for r in picked.collect()] == ["a road"]


def test_recodes(spark):
    rows = frame(spark, "mode string, yes string, cat string", ("Mobile", "Yes", "General"),
                 ("Joint Hearing", "yes", "Miscellaneous"), ("Email", "No", "Land"), ("Other", None, None))
    got = rows.select(tx.channel_of("mode", "Urgent"), tx.flag_of("yes"), tx.merged_category("cat")).collect()
    assert [tuple(r) for r in got] == [
        ("online", True, "General & Misc"), ("offline", None, "General & Misc"),
        ("freetext", False, "Land"), ("Urgent", None, None),
    ]
    assert one(spark, tx.corrected_office("c"), c="Supertendent of Police") == "Superintendent of Police"


@pytest.mark.parametrize("url, extension, web", [
    ("http://x/file~PDF", "pdf", True), ("HTTPS://x/file", "bin", True), ("www.example~pdf", "pdf", False),
    ("http://x~", "", True), ("http://x~a1", "bin", True), (None, None, False), ("", "bin", False),
])
def test_urls(spark, url, extension, web):
    assert one(spark, naming.url_extension("c"), c=url) == extension
    assert one(spark, tx.has_web_scheme("c"), c=url) is web


def test_document_name(spark):
    rows = frame(spark, "ticket_no string, url string", ("T123", "http://x/a~pdf"), ("T9", None))
    got = values(rows.select(
        naming.document_name("ticket_no", F.lit("complaint"), "url", dates.ntz("2025-07-01 15:15:00")).alias("n")
    ), "n")
    assert got == ["T123_complaint_20250701_151500.pdf", None] or got == [None, "T123_complaint_20250701_151500.pdf"]


@pytest.mark.parametrize("name, ticket", [
    ("CMO20251_complaint_20240702.pdf", "CMO20251"), ("x_GOV12_compliant_y", "GOV12_compliant"), ("none.pdf", None),
])
def test_ticket_in_name(spark, name, ticket):
    assert one(spark, naming.ticket_in_name("c"), c=name) == ticket
