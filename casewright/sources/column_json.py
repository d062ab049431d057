"""Column-oriented JSON exports: ``{"column": {"row": value, ...}, ...}``.

A converter for legacy dumps. Such a file is one JSON object and can only be parsed as
a whole, so the work is parallel over files; convert once and keep Parquet or JSON
lines from then on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewright.functions import dates

_COLUMN_MAP = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (file, text)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("file"), F.col("value").alias("text")
    )


def rows_of(documents: DataFrame, columns, epoch_columns=(), flag_columns=()) -> DataFrame:
    """Rows of (file, text) documents: ``file``, ``row_id`` and the named columns.

    Values arrive as text; ``epoch_columns`` hold epoch milliseconds and become naive
    timestamps, ``flag_columns`` become booleans. Columns a file lacks are null.
    """
    cells = (
        documents.select("file", F.explode(F.from_json("text", _COLUMN_MAP)))
        .where(F.col("key").isin(*columns))
        .select("file", F.col("key").alias("_name"), F.explode("value").alias("row_id", "_value"))
    )

    def value_of(name: str):
        value = F.max(F.when(F.col("_name") == name, F.col("_value")))
        if name in epoch_columns:
            value = dates.from_epoch_millis(value.cast("double").cast("bigint"))
        elif name in flag_columns:
            value = value.cast("boolean")
        return value.alias(name)

    return cells.groupBy("file", "row_id").agg(*[value_of(c) for c in columns])


def read_status_files(spark: SparkSession, paths_by_status: dict[int, str], columns,
                      epoch_columns=(), flag_columns=()) -> DataFrame:
    """One export per status, tagged with ``status_id`` and stacked by name."""
    from casewright.sources.landing import union_batches

    return union_batches(*[
        rows_of(read_documents(spark, path), columns, epoch_columns, flag_columns)
        .withColumn("status_id", F.lit(status))
        for status, path in sorted(paths_by_status.items())
    ])
