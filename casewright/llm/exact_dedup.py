"""Exact deduplication by a tree merge of digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import written

_KEY = ("digest", "n_bytes", "check")


def _parent(fan_in: int) -> Column:
    return F.expr(f"run div {int(fan_in)}").alias("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Every input partition is a run of (digest, best identifier, count), combined before
    anything moves. In each round ``fan_in`` neighbouring runs are merged digest by digest
    (a sort aggregate: a multiway merge of sorted runs) until one run is left; the digests
    of a run are spread over all tasks, so that no task holds a run. A digest is verified at
    each level: SHA-256, byte length and a second, unrelated hash must agree. The result
    goes back down the same tree, so a text that a third of all rows share is looked up
    once per run and level and never gathers its rows in one task.

    ``keep`` is ``largest`` or ``smallest`` identifier. Null texts count as empty; a null
    identifier loses against any other; among rows alike in text and identifier exactly one
    is kept. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    best = {"largest": F.max, "smallest": F.min}[keep]
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().cast("long").alias("run"),
    ), "dedup-rows")
    # Structs compare field by field; a missing identifier comes last in either direction.
    rank = F.struct(F.col("doc_id").isNull().alias("missing") if keep == "smallest"
                    else F.col("doc_id").isNotNull().alias("missing"),
                    F.col("doc_id").alias("id"), "row")
    level = written(
        rows.groupBy(*_KEY, "run").agg(best(rank).alias("best"), F.count(F.lit(1)).alias("n")),
        "dedup-runs",
    )
    runs = (level.agg(F.max("run")).first()[0] or 0) + 1
    levels = [level]
    while runs > 1:
        level = level.groupBy(*_KEY, _parent(fan_in)).agg(best("best").alias("best"), F.sum("n").alias("n"))
        runs = -(-runs // fan_in)
        if runs > 1:
            level = written(level, "dedup-runs")
        levels.append(level)

    decided = levels[-1].select(*_KEY, "run", "best", "n")
    for below in reversed(levels[:-1]):
        up = decided.withColumnRenamed("run", "up")
        decided = (
            below.select(*_KEY, "run", F.expr(f"run div {int(fan_in)}").alias("up"))
            .join(up, [*_KEY, "up"]).drop("up")
        )
    return rows.join(decided, [*_KEY, "run"]).select(
        "doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
