"""Ticket dictionaries: JSON maps of office to flag to ticket numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_LISTS = T.MapType(
    T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.StringType()))
)


def read_ticket_lists(spark: SparkSession, path: str) -> DataFrame:
    """Every (office, flag, ticket_no) of the dictionary files under ``path``."""
    return expand_ticket_lists(spark.read.text(path, wholetext=True), "value")


def expand_ticket_lists(documents: DataFrame, text: str) -> DataFrame:
    by_office = documents.select(F.explode(F.from_json(text, _LISTS)).alias("office", "_flags"))
    by_flag = by_office.select("office", F.explode("_flags").alias("flag", "_tickets"))
    return by_flag.select("office", "flag", F.explode("_tickets").alias("ticket_no"))


def ticket_list(lists: DataFrame, office: str, flag: str, first: int | None = None) -> DataFrame:
    """Tickets of one list. ``first`` keeps the first n by ticket number."""
    picked = lists.where((F.col("office") == office) & (F.col("flag") == flag)).select("ticket_no")
    return picked if first is None else picked.orderBy("ticket_no").limit(first)
