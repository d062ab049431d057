"""Listings of stored objects as DataFrames (the bytes are never read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.functions.naming import base_name


def list_objects(spark: SparkSession, folder: str, prefix: str = "", max_keys: int | None = None) -> DataFrame:
    """``name, path, length, modified`` of the files in a folder.

    ``prefix`` filters by name and is pushed into the listing as a glob. ``max_keys``
    keeps the first n names, as one listing page does; the default lists everything.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*")
        .load(folder)
        .select(
            base_name("path").alias("name"), "path", "length",
            F.col("modificationTime").alias("modified"),
        )
    )
    return files if max_keys is None else files.orderBy("name").limit(max_keys)
