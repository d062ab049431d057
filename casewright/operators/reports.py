"""The report catalogue over the analysis table.

Each report is one aggregation with conditional aggregates where a chain of grouped
frames and joins would read the table several times. Null group keys are left out
unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright import contracts as C
from casewright.functions import dates, numbers as num, text as tx
from casewright.operators.merge import one_per_key
from casewright.sources.landing import union_batches

Instant = Column | str | datetime
DISPOSE_DAYS = "days_to_dispose"
CHANNELS = tuple(C.CHANNEL_MODES)


# --- the analysis table ----------------------------------------------------------------------


def analysis_table(feeds: dict[int, DataFrame]) -> DataFrame:
    """Status feeds stacked by name and reduced to one row per ticket.

    The earliest row by creation, escalation and resolution time stays (nulls last, then
    the lower status).
    """
    stacked = union_batches(
        *[feed.withColumn("status_id", F.lit(status)) for status, feed in sorted(feeds.items())]
    )
    order = [
        F.col(c).asc_nulls_last()
        for c in ("created_on", "escalation_date", "resolved_on", "status_id")
        if c in stacked.columns
    ]
    first = one_per_key(stacked, ["ticket_no"], order)
    return first.withColumn("office", tx.corrected_office("office"))


def _dispose_days() -> Column:
    return dates.elapsed_days("created_on", "resolved_on")


def _open_days(as_of: Instant) -> Column:
    """Elapsed days until resolution, or until ``as_of`` when unresolved."""
    return F.when(F.col("resolved_on").isNotNull(), _dispose_days()).otherwise(
        dates.elapsed_days("created_on", dates.instant(as_of))
    )


def disposed(tickets: DataFrame) -> DataFrame:
    """Disposed tickets with their days to dispose."""
    return tickets.where(F.col("status_id") == 2).withColumn(DISPOSE_DAYS, _dispose_days())


def _grouped(tickets: DataFrame, *keys: str):
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return tickets.where(known).groupBy(*keys)


# --- counts and shares -------------------------------------------------------------------------


def counts(table: DataFrame, *keys: str, keep_nulls: bool = False, ordered: bool = True) -> DataFrame:
    """Rows per key, most frequent first; ``ordered=False`` where keys are unbounded."""
    grouped = table.groupBy(*keys) if keep_nulls else _grouped(table, *keys)
    counted = grouped.agg(F.count("*").alias("count"))
    order = [F.col("count").desc(), *[F.col(k).asc_nulls_last() for k in keys]]
    return counted.orderBy(*order) if ordered else counted


def share(table: DataFrame, key: str, digits: int | None = 1, keep_nulls: bool = False) -> DataFrame:
    """Rows per key and their percentage of all counted rows.

    The total is a scalar subquery over the grouped counts, so no single task sees all
    groups.
    """
    grouped = table.groupBy(key) if keep_nulls else _grouped(table, key)
    counted = grouped.agg(F.count("*").alias("count"))
    total = counted.select(F.sum("count")).scalar()
    return counted.select(
        key, "count", num.percent("count", total, digits).alias("percent")
    ).orderBy(F.col("count").desc(), F.col(key).asc_nulls_last())


def top_values(table: DataFrame, key: str, n: int = 5) -> DataFrame:
    return counts(table, key).limit(n)


# --- status reports ------------------------------------------------------------------------------


def overall_stats(tickets: DataFrame) -> DataFrame:
    """Tickets per office by status; a status an office lacks stays null."""
    names = {0: "unassigned", 1: "pending", 2: "disposed"}
    total = F.count("*")
    cells = {n: num.null_if_zero(F.count_if(F.col("status_id") == s)) for s, n in names.items()}
    return (
        _grouped(tickets.where(F.col("status_id").isNotNull()), "office")
        .agg(
            total.alias("total_complaints"),
            *[c.alias(f"count_{n}") for n, c in cells.items()],
            *[num.percent(c, total).alias(f"perc_{n}") for n, c in cells.items()],
        )
        .orderBy("office")
    )


def avg_time_metrics(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF, anchor: str | None = "disposed",
                     round_early: bool = False) -> DataFrame:
    """Mean days by office: to dispose, to benefit, open so far, waiting for assignment.

    Offices without a disposed ticket are left out unless ``anchor`` is None.
    ``round_early`` gives the variant whose first two columns carry a doubled prefix.
    """
    status = F.col("status_id")
    so_far = dates.calendar_days("created_on", dates.instant(as_of))
    benefit = (status == 2) & (F.col("benefitted") == "Yes")
    twice = "avg_" if round_early else ""
    columns = {
        f"{twice}avg_days_to_dispose": num.mean_where(status == 2, _dispose_days()),
        f"{twice}avg_days_to_benefit": num.mean_where(benefit, _dispose_days()),
        "avg_days_open_without_disposal": num.mean_where(status == 1, so_far),
        "avg_days_without_assignment": num.mean_where(status == 0, so_far),
    }
    rows = _grouped(tickets, "office").agg(
        *[num.zero_if_null(num.rounded(v)).alias(c) for c, v in columns.items()],
        F.count_if(status == 2).alias("_disposed"),
    )
    if anchor == "disposed":
        rows = rows.where("_disposed > 0")
    return rows.drop("_disposed").orderBy("office")


def _benefit_columns(flag: Column) -> dict[str, Column]:
    total, yes = F.count(flag), F.count_if(flag)
    return {
        "total_complaints": total,
        "disposed_and_benefitted": yes,
        "disposed_without_benefit": total - yes,
        "percent_benefitted": num.percent(yes, total),
        "percent_not_benefitted": num.percent(total - yes, total),
    }


def status2_stats(tickets: DataFrame) -> DataFrame:
    """Disposed tickets by office: benefit counts, percentages and mean days."""
    columns = _benefit_columns(tx.flag_of("benefitted"))
    means = {
        "days_to_dispose": F.avg(DISPOSE_DAYS),
        "days_to_benefit": num.mean_where(F.col("benefitted") == "Yes", DISPOSE_DAYS),
    }
    return (
        _grouped(disposed(tickets), "office")
        .agg(
            *[v.alias(c) for c, v in columns.items() if not c.startswith("percent")],
            *[num.zero_if_null(v).alias(c) for c, v in columns.items() if c.startswith("percent")],
            *[num.zero_if_null(num.rounded(v)).alias(c) for c, v in means.items()],
        )
        .orderBy("office")
    )


def days_by_benefit(tickets: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean days to dispose by benefit flag."""
    mean = F.avg(DISPOSE_DAYS)
    if digits is not None:
        mean = num.rounded(mean, digits)
    return _grouped(disposed(tickets), "benefitted").agg(mean.alias(DISPOSE_DAYS)).orderBy("benefitted")


def office_days(tickets: DataFrame) -> DataFrame:
    """Mean days to dispose by office, shortest first."""
    return (
        _grouped(disposed(tickets), "office")
        .agg(num.rounded(F.avg(DISPOSE_DAYS)).alias("avg_days_to_dispose"))
        .orderBy(F.col("avg_days_to_dispose").asc_nulls_last(), "office")
    )


def benefit_by(tickets: DataFrame, key: str) -> DataFrame:
    """Benefit counts and percentages of disposed tickets by any key, best first."""
    columns = _benefit_columns(tx.flag_of("benefitted"))
    return (
        _grouped(tickets.where(F.col("status_id") == 2), key)
        .agg(*[v.alias(c) for c, v in columns.items()])
        .orderBy(F.col("percent_benefitted").desc_nulls_last(), key)
    )


def benefit_by_mode(tickets: DataFrame) -> DataFrame:
    """Disposed tickets by mode; here the total counts rows, not answers."""
    total, yes = F.count("*"), F.count_if(F.col("benefitted") == "Yes")
    return (
        _grouped(tickets.where(F.col("status_id") == 2), "mode")
        .agg(
            total.alias("total_complaints"), yes.alias("benefitted_complaints"),
            num.percent(yes, total).alias("percent_benefitted"),
        )
        .orderBy(F.col("percent_benefitted").desc_nulls_last(), "mode")
    )


def mean_days_to_dispose(tickets: DataFrame) -> DataFrame:
    return disposed(tickets).agg(F.avg(DISPOSE_DAYS).alias("mean_days_to_dispose"))


def slow_tail(tickets: DataFrame, more_than: int = 50) -> DataFrame:
    """Disposed tickets that took more than the given days."""
    return disposed(tickets).where(F.col(DISPOSE_DAYS) > more_than)


# --- categories and topics --------------------------------------------------------------------------


def with_topic(tickets: DataFrame) -> DataFrame:
    """Tickets with merged categories and the keyword topic of their text."""
    return tickets.withColumns({
        "category": tx.merged_category("category"),
        "topic": tx.topic_of("complaint_text"),
    })


def english_with_topic(tickets: DataFrame) -> DataFrame:
    return with_topic(tickets.where(tx.is_mostly_ascii("complaint_text")))


def category_overview(tickets: DataFrame) -> DataFrame:
    return share(tickets.withColumn("category", tx.merged_category("category")), "category")


def departments_of(tickets: DataFrame, category: str) -> DataFrame:
    """Tickets per department within one (merged) category."""
    merged = tickets.withColumn("category", tx.merged_category("category"))
    return counts(merged.where(F.col("category") == category), "dept")


def topic_mix(tickets: DataFrame, category: str, dept: str) -> DataFrame:
    """Topics among mostly English tickets of one category and department."""
    picked = tickets.where(F.col("dept") == dept)
    rows = english_with_topic(picked).where(F.col("category") == category)
    return share(rows, "topic")


# --- channels -----------------------------------------------------------------------------------------


def _channel_is(channel: str) -> Column:
    return F.col("mode").isin(*C.CHANNEL_MODES[channel])


def resolution_times(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF, anchor: str | None = "online") -> DataFrame:
    """Mean days open and mean days to benefit by office for every channel.

    Offices without a ticket in the anchor channel are left out unless it is None.
    """
    opened = _open_days(as_of)
    benefit = F.col("benefitted") == "Yes"

    def whole(mean: Column) -> Column:
        return num.zero_if_null(num.rounded(mean)).cast("bigint")

    rows = _grouped(tickets, "office").agg(
        *[
            whole(num.mean_where(_channel_is(c), opened)).alias(f"avg_days_open_{c}")
            for c in CHANNELS
        ],
        *[
            whole(num.mean_where(_channel_is(c) & benefit, opened)).alias(f"avg_days_to_benefit_{c}")
            for c in CHANNELS
        ],
        *([F.count_if(_channel_is(anchor)).alias("_anchor")] if anchor else []),
    )
    if anchor:
        rows = rows.where("_anchor > 0").drop("_anchor")
    return rows.orderBy("office")


def _per_channel(tickets: DataFrame, measures: dict[str, callable], key: str) -> DataFrame:
    """One row per channel from one aggregation; an empty channel keeps its row."""
    rows = tickets.agg(F.array(*[
        F.struct(F.lit(c).alias(key), *[make(_channel_is(c)).alias(n) for n, make in measures.items()])
        for c in CHANNELS
    ]).alias("_rows"))
    return rows.select(F.inline("_rows"))


def mode_summary_table(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF) -> DataFrame:
    """Three fixed rows: totals, benefit rate and mean days by channel (one decimal)."""
    opened = _open_days(as_of)
    yes = F.col("benefitted") == "Yes"
    measures = {
        "total": lambda c: F.count_if(c),
        "benefitted": lambda c: F.count_if(c & yes),
        "benefitted_rate_%": lambda c: num.zero_if_null(num.percent(F.count_if(c & yes), F.count_if(c))),
        "avg_days_till_benefit": lambda c: num.rounded(num.mean_where(c & yes, opened), 1),
        "avg_days_till_disposed": lambda c: num.rounded(num.mean_where(c, opened), 1),
    }
    return _per_channel(tickets, measures, "mode")


def channel_benefit_days(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF) -> DataFrame:
    """The same by channel with whole-day means."""
    opened = _open_days(as_of)
    yes = F.col("benefitted") == "Yes"
    measures = {
        "n_complaints": lambda c: F.count_if(c),
        "n_benefitted": lambda c: F.count_if(c & yes),
        "benefitted_rate": lambda c: num.percent(F.count_if(c & yes), F.count_if(c)),
        "avg_days_benefitted": lambda c: num.rounded(num.mean_where(c & yes, opened)),
        "avg_days_open": lambda c: num.rounded(num.mean_where(c, opened)),
    }
    return _per_channel(tickets, measures, "channel")


def office_mode_shares(tickets: DataFrame) -> DataFrame:
    """Rows per office and mode with their percentage of the office: any number of modes."""
    counted = _grouped(tickets, "office", "mode").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy("office"))  # one row per mode of an office
    return counted.withColumn("percent", num.percent("count", total))


def office_mode_pct(tickets: DataFrame, modes: Sequence[str]) -> DataFrame:
    """Office by mode matrix of row percentages; absent cells are 0.

    ``modes`` are the columns. The row total always covers every mode.
    """
    total = F.count("mode")
    return (
        _grouped(tickets, "office")
        .agg(
            F.count("mode").alias("_n"),
            *[
                num.zero_if_null(num.percent(F.count_if(F.col("mode") == m), total)).alias(m)
                for m in modes
            ],
        )
        .where("_n > 0").drop("_n").orderBy("office")
    )


def office_mode_matrix(tickets: DataFrame, modes: Sequence[str]) -> DataFrame:
    """Office by mode counts with row percentages beside them, for the named modes."""
    total = F.count("mode")
    cell = {m: F.count_if(F.col("mode") == m) for m in modes}
    return (
        _grouped(tickets, "office")
        .agg(
            total.alias("total"),
            *[c.alias(f"{m}_count") for m, c in cell.items()],
            *[num.percent(c, total).alias(f"{m}_percent") for m, c in cell.items()],
        )
        .where("total > 0").orderBy("office")
    )


def office_channel_summary(tickets: DataFrame) -> DataFrame:
    """Office by channel counts and row percentages; unmapped modes are left out."""
    channels = sorted(CHANNELS)
    cell = {c: F.count_if(_channel_is(c)) for c in channels}
    total = F.count(tx.channel_of("mode"))
    return (
        _grouped(tickets, "office")
        .agg(
            total.alias("_n"),
            *[v.alias(f"{c}_count") for c, v in cell.items()],
            *[num.percent(v, total).alias(f"{c}_percent") for c, v in cell.items()],
        )
        .where("_n > 0").drop("_n").orderBy("office")
    )


def benefitted_pct_by_channel(tickets: DataFrame, with_total: bool = False) -> DataFrame:
    """Channel mix of benefitted tickets by office (percent of the office's row)."""
    mapped = tickets.where((F.col("benefitted") == "Yes") & tx.channel_of("mode").isNotNull())
    total = F.count("*")
    return (
        _grouped(mapped, "office")
        .agg(
            *([total.alias("total_benefitted")] if with_total else []),
            *[
                num.percent(F.count_if(_channel_is(c)), total).alias(f"{c}_benefitted_pct")
                for c in CHANNELS
            ],
        )
        .orderBy("office")
    )


def channel_overview(tickets: DataFrame, channel: str, key: str, keep_nulls: bool = True,
                     merge_general: bool = True) -> DataFrame:
    """Count and percent of one channel's tickets by office, dept or category.

    ``channel`` may be ``Urgent`` for the unmapped modes.
    """
    rows = tickets.where(tx.channel_of("mode", "Urgent") == channel)
    if merge_general and key == "category":
        rows = rows.withColumn("category", tx.merged_category("category"))
    return share(rows, key, keep_nulls=keep_nulls)


# --- duplicates and drill-downs ---------------------------------------------------------------------------


def rows_per_ticket(stacked: DataFrame) -> DataFrame:
    return counts(stacked, "ticket_no", ordered=False)


def unique_tickets(stacked: DataFrame) -> DataFrame:
    return stacked.agg(F.countDistinct("ticket_no").alias("unique_tickets"))


def topic_by(tickets: DataFrame, topic: str, key: str, dept: str | None = None) -> DataFrame:
    """Counts by ``key`` among mostly English tickets of a topic (and department)."""
    if dept is not None:
        tickets = tickets.where(F.col("dept") == dept)
    rows = english_with_topic(tickets).where(F.col("topic") == topic)
    return counts(rows, key)


def topic_outside_subcategory(tickets: DataFrame, topic: str, subcategory: str) -> DataFrame:
    """Mostly English tickets of a topic filed under another, or no, subcategory."""
    return english_with_topic(tickets).where(
        (F.col("topic") == topic) & ~F.col("subcategory").eqNullSafe(subcategory)
    )


def topic_mentions(tickets: DataFrame, topic: str, dept: str, word: str) -> DataFrame:
    """How many mostly English tickets of a topic and department mention a word."""
    rows = english_with_topic(tickets.where(F.col("dept") == dept))
    hit = (F.col("topic") == topic) & F.lower("complaint_text").contains(word)
    return rows.agg(F.count_if(hit).alias("mentions"))


def report_catalogue(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF) -> dict[str, DataFrame]:
    """The published report set, by name."""
    reports = {
        "overall_stats": overall_stats(tickets),
        "status2_stats": status2_stats(tickets),
        "category_overview": category_overview(tickets),
        "social_welfare_departments": departments_of(tickets, "Social Welfare"),
        "topic_mix": topic_mix(tickets, "Social Welfare", "Panchayati Raj & Drinking Water"),
        "resolution_times": resolution_times(tickets, as_of),
        "avg_time_metrics": avg_time_metrics(tickets, as_of),
        "mode_summary": mode_summary_table(tickets, as_of),
        "office_mode_shares": office_mode_shares(tickets),
        "office_channel_summary": office_channel_summary(tickets),
        "benefitted_pct_by_channel": benefitted_pct_by_channel(tickets),
    }
    for channel in ("online", "offline"):
        for key in ("office", "dept", "category"):
            reports[f"{channel}_by_{key}"] = channel_overview(tickets, channel, key)
    return reports
