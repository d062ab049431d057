"""Keyed merges of a batch into a table.

A merge returns the whole next table with an ``action`` column (``insert``, ``update``,
``noop`` for a batch row that changes nothing, ``kept`` for rows the batch does not
mention). The first two are the delta.
Batches are reduced to one row per key before the join: the rank filter runs on the map
side first, so copies of one key never meet in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from casewright import contracts as C

_COMPLAINT_COLUMNS = tuple(f.name for f in C.COMPLAINT_FIELDS)


def one_per_key(rows: DataFrame, keys, order: list[Column]) -> DataFrame:
    """First row per key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_in_batch(batch: DataFrame, keys, seq: str) -> DataFrame:
    return one_per_key(batch, keys, [F.col(seq).desc_nulls_last()])


def first_in_batch(batch: DataFrame, keys, seq: str) -> DataFrame:
    return one_per_key(batch, keys, [F.col(seq).asc_nulls_last()])


def changed(merged: DataFrame) -> DataFrame:
    """Inserted and updated rows of a merge result."""
    return merged.where(F.col("action").isin("insert", "update"))


def _digest(rows: DataFrame, columns: list[str]) -> Column:
    """Four 64-bit hashes of the text columns, nulls told apart."""
    parts = [e for c in columns for e in (F.col(c).isNull(), F.col(c))]
    return F.struct(*[F.xxhash64(F.lit(i), *parts).alias(f"h{i}") for i in range(4)])


def merge(existing: DataFrame, incoming: DataFrame, keys, update_columns, *,
          insert_defaults: dict[str, object] | None = None, update_when: Column | bool = True,
          insert_new: bool = True, whole: bool = True, seq: str | None = None) -> DataFrame:
    """Merge ``incoming`` (one row per key, or with ``seq`` the last of each) into ``existing``
    on non-null ``keys``.

    ``whole=False`` leaves out the rows that the batch does not mention: the batch is then
    the outer side, and the table need not be shuffled where the batch is small.

    ``update_columns`` are overwritten, null values included; other columns of
    ``existing`` are kept and take ``insert_defaults`` on new rows. ``update_when``
    false leaves matched rows alone. Texts are compared by digests taken before the shuffles,
    so those that the caller does not select stay where they are.
    """
    keys, update_columns = list(keys), list(update_columns)
    insert_defaults = insert_defaults or {}
    texts = [c for c in update_columns if isinstance(existing.schema[c].dataType, T.StringType)]
    others = [c for c in update_columns if c not in texts]
    order = {} if seq is None else {"_seq": F.col(seq)}
    new = incoming.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in update_columns],
        _digest(incoming, texts).alias("_new_digest"), F.lit(True).alias("_in"), *[c.alias(n) for n, c in order.items()],
    )
    if seq is not None:
        new = last_in_batch(new, keys, "_seq").drop("_seq")
    table = existing.withColumns({"_digest": _digest(existing, texts), "_ex": F.lit(True)})
    if whole:
        joined = table.join(new, keys, "full_outer" if insert_new else "left")
    else:
        joined = new.join(table, keys, "left" if insert_new else "inner")
    in_table = F.col("_ex").isNotNull()
    in_batch = F.col("_in").isNotNull()
    allowed = F.lit(update_when) if isinstance(update_when, bool) else update_when
    same = F.struct("_digest", *others).eqNullSafe(F.struct("_new_digest", *[f"_new_{c}" for c in others]))
    action = (
        F.when(~in_batch, F.lit("kept"))
        .when(~in_table, F.lit("insert"))
        .when(allowed & ~same, F.lit("update"))
        .otherwise(F.lit("noop"))
    )
    take_new = in_batch & (~in_table | allowed)
    columns = []
    for name in existing.columns:
        if name in keys:
            columns.append(F.col(name))
        elif name in update_columns:
            columns.append(F.when(take_new, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        elif name in insert_defaults:
            default = F.lit(insert_defaults[name]).cast(existing.schema[name].dataType)
            columns.append(F.when(~in_table, default).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns, action.alias("action"))


# --- districts -----------------------------------------------------------------------------


def merge_districts(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Insert new districts and rename known ones; the last batch row of an id wins."""
    return merge(existing, last_in_batch(batch, ["dist_id"], seq), ["dist_id"], ["dist_name"])


def load_districts(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq",
                   rename: str = "on_duplicate") -> DataFrame:
    """Bulk load: insert unseen districts only.

    Known names stay as they are with ``rename="never"``. The default also renames when
    the batch repeats an unseen id, which is when the bulk insert gives way to the
    row-wise one. ``rename="always"`` is :func:`merge_districts`.
    """
    if rename == "always":
        return merge_districts(existing, batch, seq)
    latest = last_in_batch(batch, ["dist_id"], seq)
    if rename == "never":
        return merge(existing, latest, ["dist_id"], ["dist_name"], update_when=False)
    if rename != "on_duplicate":
        raise ValueError(f"unknown rename rule {rename!r}")
    repeats = (
        batch.groupBy("dist_id").agg(F.count("*").alias("n")).where("n > 1")
        .join(existing.select("dist_id"), "dist_id", "left_anti")
        .select(F.count("*") > 0).scalar()
    )
    return merge(existing, latest, ["dist_id"], ["dist_name"], update_when=repeats)


# --- complaints ----------------------------------------------------------------------------


def merge_complaints(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq",
                     whole: bool = True) -> DataFrame:
    """All source fields are overwritten, document columns survive, last row wins.

    Serves the single, batch and bulk loads.
    """
    return merge(
        existing, batch, ["ticket_no"], [c for c in _COMPLAINT_COLUMNS if c != "ticket_no"],
        insert_defaults={"document_downloaded": False}, whole=whole, seq=seq,
    )


def changed_complaints(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """What the bulk load reports: inserted and updated tickets, unchanged ones excluded."""
    return changed(merge_complaints(existing, batch, seq, whole=False))


# --- action history ------------------------------------------------------------------------

_ACTION_COLUMNS = tuple(f.name for f in C.ACTION_FIELDS)


def new_actions(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Batch rows whose five-part key is neither in the table nor earlier in the batch.

    Both sides are spread by the whole key, which is unique, so a ticket with very many
    actions does not gather anywhere.
    """
    first = first_in_batch(batch, C.ACTION_KEY, seq)
    known = existing.select(*C.ACTION_KEY)
    match = [first[c].eqNullSafe(known[c]) for c in C.ACTION_KEY]
    return first.join(known, match, "left_anti").select(*_ACTION_COLUMNS)


def append_actions(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Insert-only load: duplicates by the five-part key are skipped, the first wins."""
    return existing.select(*_ACTION_COLUMNS).withColumn("action", F.lit("kept")).unionByName(
        new_actions(existing, batch, seq).withColumn("action", F.lit("insert"))
    )


def _tickets_of(existing: DataFrame, batch: DataFrame) -> tuple[DataFrame, Column]:
    """The batch's tickets and their match with ``existing``."""
    named = batch.select(F.col("ticket_no").alias("_named")).distinct()
    return named, existing["ticket_no"].eqNullSafe(named["_named"])


def _loaded(existing: DataFrame, batch: DataFrame, seq: str) -> DataFrame:
    """Stored and new actions with ``action``: kept, gone, insert or update, and ``seq``.

    One union of both sides: a count by the five-part key decides what is new, a count by
    (ticket, date) what replaces what. Both combine on the map side. The mark joins by a
    hash of the other columns as well, so the rows of a crowded slot, or of a ticket
    without any dates, spread over the cluster.
    """
    slot = ["ticket_no", "action_taken_date"]
    # Stored tickets that the batch does not mention take no part.
    stored = existing.join(*_tickets_of(existing, batch), "left_semi").select(*_ACTION_COLUMNS, F.lit(0).alias("_src"), F.lit(None).cast("long").alias("_seq"))
    new = batch.select(*_ACTION_COLUMNS, F.lit(1).alias("_src"), F.col(seq).cast("long").alias("_seq"))
    # Stored rows come before new ones, then the first by sequence, nulls last.
    rank = F.struct("_src", F.col("_seq").isNull().alias("_late"), "_seq", "action_taken_date")
    rows = (
        stored.unionByName(new).groupBy(*C.ACTION_KEY).agg(F.min(rank).alias("_first"))
        .select(*C.ACTION_KEY, "_first.action_taken_date", "_first._src", "_first._seq")
        .withColumn("_row", F.xxhash64(*[c for c in _ACTION_COLUMNS if c not in slot]))
    )

    def only(src: int) -> Column:
        return F.max(F.when(F.col("_src") == src, F.struct("_row", "_seq")))

    lone = (
        rows.where(F.col("action_taken_date").isNotNull()).groupBy(*slot)
        .agg(F.count_if(F.col("_src") == 0).alias("_old"), F.count_if(F.col("_src") == 1).alias("_new"),
             only(0).alias("_stored"), only(1).alias("_arrived"))
        .where("_old = 1 AND _new = 1")
    )
    marks = lone.select(*slot, F.explode(F.array(
        F.struct(F.col("_stored._row").alias("_row"), F.lit("gone").alias("_mark"), F.col("_arrived._seq").alias("_by")),
        F.struct(F.col("_arrived._row").alias("_row"), F.lit("update").alias("_mark"), F.col("_arrived._seq").alias("_by")),
    )).alias("m")).select(*slot, "m.*")
    default = F.when(F.col("_src") == 0, F.lit("kept")).otherwise(F.lit("insert"))
    return rows.join(marks, [*slot, "_row"], "left").select(
        *_ACTION_COLUMNS, F.coalesce("_mark", default).alias("action"), F.coalesce("_by", "_seq").alias("_seq"))


def load_actions(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Bulk load of action histories; ``existing`` is unique on the five-part key.

    The five-part key decides what is new. A new row that carries a date shared with
    exactly one stored and one new row of its ticket replaces that stored row; every
    other new row is inserted. Rows without date are only ever inserted.
    """
    stays = existing.select(*_ACTION_COLUMNS, F.lit("kept").alias("action")).join(*_tickets_of(existing, batch), "left_anti")
    return _loaded(existing, batch, seq).where("action != 'gone'").drop("_seq").unionByName(stays)


def action_changes(existing: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """The rows that :func:`load_actions` adds, and with ``gone`` those that it replaces;
    both carry ``seq`` of the new row."""
    return _loaded(existing, batch, seq).where("action != 'kept'").select(
        *_ACTION_COLUMNS, F.col("_seq").alias(seq), (F.col("action") == "gone").alias("gone"))
