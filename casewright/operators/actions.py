"""Action-history analytics: status tokens per ticket and forwarding times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casewright import contracts as C
from casewright.functions import dates, numbers as num
from casewright.operators.reports import counts


OTHER = "Other"


def actions_for(actions: DataFrame, tickets: DataFrame) -> DataFrame:
    """Actions of the listed tickets (any listing, duplicates allowed)."""
    wanted = tickets.select("ticket_no").where(F.col("ticket_no").isNotNull()).distinct()
    return actions.join(wanted, "ticket_no", "left_semi").select(*actions.columns)


def distinct_tickets(actions: DataFrame) -> DataFrame:
    return actions.agg(F.countDistinct("ticket_no").alias("distinct_tickets"))


def remark_counts(actions: DataFrame) -> DataFrame:
    return counts(actions, "action_taken_remark", ordered=False)


def distinct_statuses(actions: DataFrame) -> DataFrame:
    return actions.select("action_status").distinct()


def _is(status: str) -> Column:
    return F.coalesce(F.col("action_status") == status, F.lit(False))


def _is_other(statuses) -> Column:
    return ~F.coalesce(F.col("action_status").isin(*statuses), F.lit(False))


def status_counts(actions: DataFrame) -> DataFrame:
    """How often each status occurs, whatever it is."""
    return counts(actions, "action_status", keep_nulls=True)


def with_status_flags(actions: DataFrame, statuses=C.ACTION_STATUSES) -> DataFrame:
    """One boolean column per status, and ``Other`` for any status that is not listed."""
    return actions.withColumns({s: _is(s) for s in statuses} | {OTHER: _is_other(statuses)})


def flagged(actions: DataFrame, status: str) -> DataFrame:
    return with_status_flags(actions).where(F.col(status))


def status_tokens(actions: DataFrame, statuses=C.ACTION_STATUSES) -> DataFrame:
    """How often each status, and any other one, occurs per ticket."""
    return (
        actions.where(F.col("ticket_no").isNotNull()).groupBy("ticket_no")
        .agg(*[F.count_if(_is(s)).alias(s) for s in statuses], F.count_if(_is_other(statuses)).alias(OTHER))
    )


def token_totals(tokens: DataFrame, required=("Complaint Assigned", "Complaint Register"),
                 statuses=C.ACTION_STATUSES) -> DataFrame:
    """Column totals over the tickets that have all required statuses."""
    has_all = reduce(lambda a, b: a & b, [F.col(s) > 0 for s in required])
    return tokens.where(has_all).agg(
        F.count("*").alias("tickets"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in statuses],
    )


def with_token_sum(tokens: DataFrame, statuses=C.ACTION_STATUSES) -> DataFrame:
    return tokens.withColumn("sum", reduce(lambda a, b: a + b, [F.col(s) for s in statuses]))


def token_sum_distribution(actions: DataFrame) -> DataFrame:
    """How many tickets have each number of counted actions."""
    return counts(with_token_sum(status_tokens(actions)), "sum")


def busy_ticket_actions(actions: DataFrame, more_than: int = 7) -> DataFrame:
    """All actions of tickets with more than so many counted actions."""
    busy = with_token_sum(status_tokens(actions)).where(F.col("sum") > more_than)
    return actions.join(busy.select("ticket_no"), "ticket_no", "left_semi").select(*actions.columns)


def forwarding_times(actions: DataFrame) -> DataFrame:
    """Days between first and last action, the part spent forwarding, and its percent.

    The percentage is taken of the rounded days; 0 of 0 gives null.
    """
    forwarding = F.col("action_status").isin(*C.FORWARDING_STATUSES)

    def span(value: Column) -> Column:
        return num.rounded(dates.fractional_days(F.min(value), F.max(value)), 1)

    when = F.col("action_taken_date")
    return (
        actions.where(F.col("ticket_no").isNotNull()).groupBy("ticket_no")
        .agg(
            span(when).alias("total_days_diff"),
            span(F.when(forwarding, when)).alias("days_to_fw"),
        )
        .withColumn("potential_savings", num.percent("days_to_fw", "total_days_diff"))
    )
