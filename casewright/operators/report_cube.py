"""The published report set from one scan of the analysis table.

One aggregation over ``GROUPING SETS`` counts tickets and adds up days for every combination
of values that any report asks for. Its size is bounded by the values of offices, modes,
statuses, answers, departments, categories and topics, not by the number of tickets. All
reports are cut from it; they have the rows of their namesakes in ``reports``, null groups
included. Days are whole numbers, so means of sums are the same to the last digit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright import contracts as C
from casewright.functions import dates, numbers as num, text as tx
from casewright.operators.reports import CHANNELS, Instant

_DIMENSIONS = ("office", "mode", "status_id", "benefitted", "dept", "category", "topic")
#: What reports group by or filter on, together.
_SETS = {
    "office": ("office", "mode", "status_id", "benefitted"),
    "dept": ("mode", "dept"),
    "category": ("mode", "category"),
    "topic": ("category", "dept", "topic"),
}
TOPIC_CATEGORY, TOPIC_DEPT = "Social Welfare", "Panchayati Raj & Drinking Water"


def cube(tickets: DataFrame, as_of: Instant = C.DEFAULT_AS_OF, category: str = TOPIC_CATEGORY,
         dept: str = TOPIC_DEPT) -> DataFrame:
    """Counts and sums of days by ``cut`` (the name of a grouping set) and its dimensions.

    ``topic`` is that of mostly English tickets of one (merged) category and department,
    else null: no other text is looked at.
    """
    merged = tx.merged_category("category")
    asked = (F.col("dept") == dept) & (merged == category) & tx.is_mostly_ascii("complaint_text")
    days = {
        "disposed": dates.elapsed_days("created_on", "resolved_on"),
        "open": F.when(F.col("resolved_on").isNotNull(), dates.elapsed_days("created_on", "resolved_on")).otherwise(
            dates.elapsed_days("created_on", dates.instant(as_of))),
        "so_far": dates.calendar_days("created_on", dates.instant(as_of)),
    }
    facts = tickets.select(
        "office", "mode", "status_id", "benefitted", "dept", merged.alias("category"),
        F.when(asked, tx.topic_of("complaint_text")).alias("topic"), *[v.alias(f"days_{n}") for n, v in days.items()])
    sums = [f(f"days_{n}").alias(f"{kind}_{n}") for n in days for kind, f in (("sum", F.sum), ("n", F.count))]
    rows = facts.groupingSets([[F.col(c) for c in s] for s in _SETS.values()], *_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set"), *sums)
    # A dimension that a set lacks sets its bit, the first dimension the highest.
    bits = {name: sum(1 << (len(_DIMENSIONS) - 1 - i) for i, d in enumerate(_DIMENSIONS) if d not in own)
            for name, own in _SETS.items()}
    cut = reduce(lambda ladder, x: ladder.when(F.col("_set") == x[1], F.lit(x[0])), bits.items(), F)
    return rows.withColumn("cut", cut).drop("_set")


def _cut(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(F.col("cut") == name)


def _n(where: Column | None = None) -> Column:
    """Tickets, as ``count_if`` counts them."""
    return F.coalesce(F.sum(F.col("n") if where is None else F.when(where, F.col("n"))), F.lit(0))


def _mean(days: str, where: Column) -> Column:
    total, n = (F.sum(F.when(where, F.col(f"{kind}_{days}"))) for kind in ("sum", "n"))
    return F.try_divide(total.cast("double"), n.cast("double"))


def _by(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(key)


def _share(rows: DataFrame, key: str, keep_nulls: bool = False) -> DataFrame:
    counted = (rows.groupBy(key) if keep_nulls else _by(rows, key)).agg(_n().alias("count"))
    total = counted.select(F.sum("count")).scalar()
    return counted.select(key, "count", num.percent("count", total).alias("percent")).orderBy(
        F.col("count").desc(), F.col(key).asc_nulls_last())


def _answer(value: str) -> Column:
    return F.coalesce(F.col("benefitted") == value, F.lit(False))


def _channel_is(channel: str) -> Column:
    return F.col("mode").isin(*C.CHANNEL_MODES[channel])


def overall_stats(rows: DataFrame) -> DataFrame:
    names, status = {0: "unassigned", 1: "pending", 2: "disposed"}, F.col("status_id")
    cells = {n: num.null_if_zero(_n(status == s)) for s, n in names.items()}
    return _by(_cut(rows, "office").where(status.isNotNull()), "office").agg(
        _n().alias("total_complaints"), *[c.alias(f"count_{n}") for n, c in cells.items()],
        *[num.percent(c, _n()).alias(f"perc_{n}") for n, c in cells.items()]).orderBy("office")


def status2_stats(rows: DataFrame) -> DataFrame:
    yes, no, every = _n(_answer("Yes")), _n(_answer("No")), F.lit(True)
    return _by(_cut(rows, "office").where("status_id = 2"), "office").agg(
        (yes + no).alias("total_complaints"), yes.alias("disposed_and_benefitted"), no.alias("disposed_without_benefit"),
        num.zero_if_null(num.percent(yes, yes + no)).alias("percent_benefitted"),
        num.zero_if_null(num.percent(no, yes + no)).alias("percent_not_benefitted"),
        num.zero_if_null(num.rounded(_mean("disposed", every))).alias("days_to_dispose"),
        num.zero_if_null(num.rounded(_mean("disposed", _answer("Yes")))).alias("days_to_benefit")).orderBy("office")


def avg_time_metrics(rows: DataFrame) -> DataFrame:
    status = F.col("status_id")
    means = {
        "avg_days_to_dispose": _mean("disposed", status == 2),
        "avg_days_to_benefit": _mean("disposed", (status == 2) & _answer("Yes")),
        "avg_days_open_without_disposal": _mean("so_far", status == 1),
        "avg_days_without_assignment": _mean("so_far", status == 0),
    }
    return _by(_cut(rows, "office"), "office").agg(
        *[num.zero_if_null(num.rounded(v)).alias(c) for c, v in means.items()], _n(status == 2).alias("_disposed"),
    ).where("_disposed > 0").drop("_disposed").orderBy("office")


def resolution_times(rows: DataFrame, anchor: str = "online") -> DataFrame:
    def whole(mean: Column) -> Column:
        return num.zero_if_null(num.rounded(mean)).cast("bigint")

    return _by(_cut(rows, "office"), "office").agg(
        *[whole(_mean("open", _channel_is(c))).alias(f"avg_days_open_{c}") for c in CHANNELS],
        *[whole(_mean("open", _channel_is(c) & _answer("Yes"))).alias(f"avg_days_to_benefit_{c}") for c in CHANNELS],
        _n(_channel_is(anchor)).alias("_anchor")).where("_anchor > 0").drop("_anchor").orderBy("office")


def mode_summary_table(rows: DataFrame) -> DataFrame:
    def line(channel: str) -> Column:
        own, yes = _channel_is(channel), _channel_is(channel) & _answer("Yes")
        return F.struct(
            F.lit(channel).alias("mode"), _n(own).alias("total"), _n(yes).alias("benefitted"),
            num.zero_if_null(num.percent(_n(yes), _n(own))).alias("benefitted_rate_%"),
            num.rounded(_mean("open", yes), 1).alias("avg_days_till_benefit"),
            num.rounded(_mean("open", own), 1).alias("avg_days_till_disposed"))

    return _cut(rows, "office").agg(F.array(*[line(c) for c in CHANNELS]).alias("_rows")).select(F.inline("_rows"))


def office_mode_shares(rows: DataFrame) -> DataFrame:
    counted = _cut(rows, "office").where("office IS NOT NULL AND mode IS NOT NULL").groupBy("office", "mode").agg(_n().alias("count"))
    total = F.sum("count").over(Window.partitionBy("office"))  # one row per mode of an office
    return counted.withColumn("percent", num.percent("count", total))


def office_channel_summary(rows: DataFrame) -> DataFrame:
    channels, total = sorted(CHANNELS), _n(tx.channel_of("mode").isNotNull())
    return _by(_cut(rows, "office"), "office").agg(
        total.alias("_n"), *[_n(_channel_is(c)).alias(f"{c}_count") for c in channels],
        *[num.percent(_n(_channel_is(c)), total).alias(f"{c}_percent") for c in channels],
    ).where("_n > 0").drop("_n").orderBy("office")


def benefitted_pct_by_channel(rows: DataFrame) -> DataFrame:
    mapped = _cut(rows, "office").where(_answer("Yes") & tx.channel_of("mode").isNotNull())
    return _by(mapped, "office").agg(
        *[num.percent(_n(_channel_is(c)), _n()).alias(f"{c}_benefitted_pct") for c in CHANNELS]).orderBy("office")


def channel_overview(rows: DataFrame, channel: str, key: str) -> DataFrame:
    return _share(_cut(rows, key).where(tx.channel_of("mode", "Urgent") == channel), key, keep_nulls=True)


def report_catalogue(rows: DataFrame, category: str = TOPIC_CATEGORY) -> dict[str, DataFrame]:
    """The published report set, by name, from a stored cube."""
    departments = _by(_cut(rows, "topic").where(F.col("category") == category), "dept").agg(_n().alias("count")).orderBy(
        F.col("count").desc(), "dept")
    found = {
        "overall_stats": overall_stats(rows),
        "status2_stats": status2_stats(rows),
        "category_overview": _share(_cut(rows, "category"), "category"),
        "social_welfare_departments": departments,
        "topic_mix": _share(_cut(rows, "topic"), "topic"),
        "resolution_times": resolution_times(rows),
        "avg_time_metrics": avg_time_metrics(rows),
        "mode_summary": mode_summary_table(rows),
        "office_mode_shares": office_mode_shares(rows),
        "office_channel_summary": office_channel_summary(rows),
        "benefitted_pct_by_channel": benefitted_pct_by_channel(rows),
    }
    for channel in ("online", "offline"):
        for key in ("office", "dept", "category"):
            found[f"{channel}_by_{key}"] = channel_overview(rows, channel, key)
    return found
