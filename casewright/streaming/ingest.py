"""Incremental ingest of landed envelopes with Structured Streaming.

The file source remembers which landed files it has seen; every micro-batch is unwrapped,
conformed and committed under the identity of the query and the number of the batch. A
batch that is replayed overwrites its own commit and nothing else; the stream itself keeps
no state. What was rejected is written before the commit, under the same name.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright.operators import conform, merge
from casewright.sources.landing import unwrap_envelopes
from casewright.sources.tables import Table, open_table, remove


@dataclass(frozen=True)
class Feed:
    """What a landed folder holds and what it changes in its table: rows with
    ``ingest_seq``, and where a row leaves the table."""

    table: str
    conform: Callable[[DataFrame], conform.Conformed]
    changes: Callable[[Callable[[], DataFrame], DataFrame], tuple[DataFrame, Column | None]]
    landed: str = "value STRING, ingest_seq BIGINT"


def _complaint_changes(table, batch: DataFrame):
    """The last row of a ticket; the table is not read. Whole rows, with their texts, are
    shuffled only if a ticket is repeated."""
    repeated = batch.groupBy("ticket_no").agg(F.count("*").alias("n")).where("n > 1")
    return (batch if repeated.isEmpty() else merge.last_in_batch(batch, ["ticket_no"], "ingest_seq")), None


def _district_changes(table, batch: DataFrame):
    loaded = merge.changed(merge.load_districts(table(), batch)).select("dist_id")
    return merge.last_in_batch(batch, ["dist_id"], "ingest_seq").join(loaded, "dist_id", "left_semi"), None


def _action_changes(table, batch: DataFrame):
    return merge.action_changes(table(), batch, "ingest_seq"), F.col("gone")


FEEDS = {
    "districts": Feed("districts", conform.conform_districts, _district_changes),
    "complaints": Feed("complaints", conform.conform_complaints, _complaint_changes),
    "actions": Feed("action_history", conform.conform_actions, _action_changes,
                    "request_ticket STRING, value STRING, ingest_seq BIGINT"),
}


def apply_batch(feed: Feed, table: Table, rejects_root: str, envelopes: DataFrame,
                source: str, batch: str | int) -> None:
    """Commit one batch of envelopes (``value``, ``ingest_seq`` and, for actions,
    ``request_ticket``) and, before it, what was rejected."""
    unwrapped = unwrap_envelopes(envelopes)
    rejects = f"{rejects_root}/{feed.table}"
    unwrapped.rejects.write.mode("overwrite").parquet(f"{rejects}/envelopes/{source}/{batch}")
    staged = f"{rejects}/staged/{source}/{batch}"  # read for the commit and for the rejects
    try:
        result = conform.settled(feed.conform(unwrapped.records), staged)
        result.rejects.write.mode("overwrite").parquet(f"{rejects}/records/{source}/{batch}")
        rows, gone = feed.changes(lambda: table.read(without=(source, batch)), result.valid)
        table.append(rows, source, batch, "ingest_seq", gone=gone)
    finally:
        remove(envelopes.sparkSession, staged)


def start(spark: SparkSession, kind: str, landing: str, root: str, checkpoint: str,
          files_per_batch: int = 1000):
    """Start an available-now query over the landed JSON files of one kind.

    Each landed line is a JSON object with the envelope text and its arrival number. A batch
    takes ``files_per_batch`` files at most. Returns the streaming query; await it to finish
    the backlog. A new checkpoint is a new query: it reads all files again and commits them
    under its own name, which changes nothing.
    """
    feed, table = FEEDS[kind], open_table(spark, root, FEEDS[kind].table)
    named, names = threading.Event(), []

    def commit(batch: DataFrame, batch_id: int) -> None:
        named.wait()  # the identity of the query is known once it has started
        apply_batch(feed, table, f"{root}/_rejects", batch, names[0], batch_id)

    query = (
        spark.readStream.schema(feed.landed).option("maxFilesPerTrigger", files_per_batch)
        .json(landing).writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    names.append(str(query.id))
    named.set()
    return query


def ingest_once(spark: SparkSession, kind: str, landing: str, root: str, batch: str | None = None) -> None:
    """The same as one plain batch over everything landed."""
    feed = FEEDS[kind]
    envelopes = spark.read.schema(feed.landed).json(landing)
    apply_batch(feed, open_table(spark, root, feed.table), f"{root}/_rejects", envelopes,
                "once", batch or uuid.uuid4().hex)
