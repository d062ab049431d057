"""Landed API responses: JSON envelopes to one row per record."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewright import contracts as C
from casewright.functions.base import pinned, where_pinned

CELL_PARTITIONS = T.StructType(
    [T.StructField("value", T.StringType())]
    + [T.StructField(k, T.IntegerType()) for k in C.CELL_KEYS]
)


def read_envelopes(spark: SparkSession, path: str, partitioned: bool = False) -> DataFrame:
    """One envelope per line. With ``partitioned`` the folders carry the fetch cell
    (``year=/dist_id=/status=/office=``), so filters on it prune files."""
    reader = spark.read
    if partitioned:
        reader = reader.schema(CELL_PARTITIONS)
    return reader.text(path)


def write_envelopes(envelopes: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Land envelope text (column ``value``) the way a fetcher does."""
    writer = envelopes.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


@dataclass(frozen=True)
class Unwrapped:
    """``records``: carried columns, ``pos``, ``record`` (variant).
    ``rejects``: carried columns, ``value``, ``reason``."""

    records: DataFrame
    rejects: DataFrame


def _present(body: Column) -> list[Column]:
    """The value of each envelope key, null where the key is absent."""
    return [F.variant_get(body, f"$.{key}", "variant") for key in C.ENVELOPE_KEYS]


def _records(body: Column) -> Column:
    """Records of the first envelope key that is present; null if that is no list.

    Each record is copied once. A key is looked at as a whole only if it is no list.
    """
    found = F.lit(None).cast("array<variant>")
    for key, value in reversed(list(zip(C.ENVELOPE_KEYS, _present(body), strict=True))):
        found = F.coalesce(F.try_variant_get(body, f"$.{key}", "array<variant>"), F.when(value.isNull(), found))
    return found


def open_envelopes(envelopes: DataFrame, text: str = "value") -> DataFrame:
    """Adds ``payload`` (array of variants) and ``reason`` (null for a usable or empty answer).

    The result is pinned, see :func:`casewright.functions.base.pinned`.
    """
    parsed = envelopes.withColumn("_body", F.try_parse_json(F.col(text)))
    body = F.col("_body")
    code = F.variant_get(body, "$.status", "variant")
    coded = F.when(F.schema_of_variant(code) == "BIGINT", code.try_cast("bigint"))
    listed = parsed.withColumns({"_status": coded, "_list": _records(body)})
    status, other = F.col("_status"), F.coalesce(*_present(body))
    reason = (
        F.when(body.isNull(), F.lit("not_json"))
        .when(status.isNull() | ~status.isin(200, 204), F.lit("error_status"))
        .when((status == 200) & F.col("_list").isNull(),
              F.when(other.isNull(), F.lit("no_payload")).when(~F.is_variant_null(other), F.lit("not_a_list")))
    )
    return listed.select(*pinned(
        [*envelopes.columns, F.when(status == 200, F.col("_list")).alias("payload"), reason.alias("reason")]
    ))


def unwrap_envelopes(envelopes: DataFrame, text: str = "value") -> Unwrapped:
    """Status 200 yields its records, 204 yields none, all else is rejected with a reason."""
    opened = open_envelopes(envelopes, text)
    carried = [c for c in envelopes.columns if c != text]
    usable = where_pinned(opened, F.col("payload").isNotNull()).select(*carried, "payload")
    records = usable.select(*carried, F.posexplode("payload").alias("pos", "record"))
    rejects = where_pinned(opened, F.col("reason").isNotNull()).select(*carried, text, "reason")
    return Unwrapped(records, rejects)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Batches stacked by column name; columns a batch lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
