"""Chat formatting: logged conversations that another one continues are dropped, the rest rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casewright.llm.common import discard, written

_HASHES = ("h1", "h2")
_ORDER = ("turn", "role", "text")
#: Characters of a role and of a text that decide in which range a turn lies.
_ROLE, _TEXT = 64, 256


def _placed(turns: DataFrame) -> DataFrame:
    """``conv_id, role, text, pos, n_turns`` and the hashes ``h1, h2`` of (place, role, text),
    with ``stretch``, the range that holds the row.

    Rows are dealt out by a range sort on beginnings of roles and texts (the ranges are
    sampled on the driver, whole texts never are), so a conversation of any length is spread
    over tasks; one row per range and conversation gives the bases of the positions. Rows that
    are alike may lie in several ranges unless their texts are longer than those beginnings.
    """
    role, text = F.substring("role", 1, _ROLE), F.substring("text", 1, _TEXT)
    whole_role = F.coalesce(F.length("role"), F.lit(0)) <= _ROLE
    whole = whole_role & (F.coalesce(F.length("text"), F.lit(0)) <= _TEXT)
    ranges = ["conv_id", "turn", role, F.when(whole_role, text), F.when(whole, F.monotonically_increasing_id())]
    dealt = turns.select("conv_id", *_ORDER).repartitionByRange(*[
        (F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in ranges])
    dealt = written(dealt.withColumn("stretch", F.spark_partition_id()), "chat-turns")
    conversation = Window.partitionBy("conv_id")
    before = conversation.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("stretch", "conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "stretch", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(conversation).alias("n_turns"))
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    within = Window.partitionBy("stretch", "conv_id").orderBy(*order)
    rows = _by_stretch(dealt, counts).withColumn("pos", F.col("base") + F.row_number().over(within)).drop("base", "turn")
    out = written(rows.withColumns({
        h: F.xxhash64(F.lit(h), "pos", F.coalesce("role", F.lit("\x00")), F.col("role").isNull(),
                      F.coalesce("text", F.lit("")), F.col("text").isNull())
        for h in _HASHES
    }), "chat-placed")
    discard(dealt)
    return out


def _by_stretch(rows: DataFrame, of_stretch: DataFrame) -> DataFrame:
    """Join what is known of the part of a conversation in a range to its rows."""
    right = of_stretch.withColumnsRenamed({"conv_id": "c_id", "stretch": "c_stretch"})
    same = (F.col("stretch") == F.col("c_stretch")) & F.col("conv_id").eqNullSafe(F.col("c_id"))
    return rows.join(right, same).drop("c_id", "c_stretch")


def _rolled(placed: DataFrame) -> DataFrame:
    """``conv_id, pos, n_turns, h1, h2``: the hashes rolled over the turns up to each."""
    ends = placed.groupBy("stretch", "conv_id").agg(*[F.bit_xor(h).alias(h) for h in _HASHES])
    rolling = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("stretch", "conv_id", *[F.coalesce(F.bit_xor(h).over(rolling), F.lit(0)).alias(f"{h}_before") for h in _HASHES])
    within = Window.partitionBy("stretch", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    joined = _by_stretch(placed.select("stretch", "conv_id", "pos", "n_turns", *_HASHES), ends)
    return joined.select("conv_id", "pos", "n_turns", *[
        F.col(f"{h}_before").bitwiseXOR(F.bit_xor(h).over(within)).alias(h) for h in _HASHES])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, n_turns, h1, h2`` of ``conv_id, turn, role, text``; ``pos`` counts from 1.

    Turns are ordered by turn, role and text, nulls first. The hashes roll over the turns:
    each is the exclusive or of the hashes of (place, role, text) up to this turn, so equal
    hashes at the same place mean equal prefixes (2 x 64 bits).
    """
    return _rolled(_placed(turns))


def _maximal(prefixes: DataFrame) -> DataFrame:
    whole = prefixes.where("pos = n_turns").groupBy("pos", *_HASHES).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_logged"))
    proper = prefixes.where("pos < n_turns").select("pos", *_HASHES).distinct()
    kept = whole.join(proper, ["pos", *_HASHES], "left_anti")
    return kept.select("conv_id", F.col("pos").alias("n_turns"), "n_logged")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """Conversations that no other continues: ``conv_id, n_turns, n_logged``.

    Of conversations with the same turns the smallest identifier stays (null last);
    ``n_logged`` is how many there were. All prefixes are made distinct before the
    anti-join, so a first turn that very many conversations share is one row in it.
    """
    return _maximal(written(prefix_hashes(turns), "chat-prefixes"))


def format_chats(turns: DataFrame, open_mark: str = "<|", close_mark: str = "|>", end: str = "<|end|>", chunk: int = 256) -> DataFrame:
    """One row per maximal conversation: ``conv_id, n_turns, n_logged, text``.

    A turn renders as ``<|role|>``, a line break, its text, ``<|end|>`` and a line break.
    A conversation that is a proper prefix of another one, or a repetition with a larger
    identifier, is dropped. Null roles and texts render as empty but differ from empty ones
    when conversations are compared; a null ``conv_id`` is a conversation of its own;
    null turns come first, before negative ones; repeated turn rows all count; other columns
    are ignored. ``chunk`` turns are rendered together, then the chunks of a conversation
    are joined: its rendered text is one value (2 GB at most).
    """
    placed = _placed(turns)
    prefixes = written(_rolled(placed), "chat-prefixes")
    kept = written(_maximal(prefixes), "chat-kept")
    discard(prefixes)
    names = kept.select(F.col("conv_id").alias("k_id"), "n_logged")
    rendered = F.concat(F.lit(open_mark), F.coalesce("role", F.lit("")), F.lit(close_mark + "\n"),
                        F.coalesce("text", F.lit("")), F.lit(end + "\n"))
    turns_kept = placed.join(names, F.col("conv_id").eqNullSafe(F.col("k_id"))).select(
        "conv_id", "n_turns", "n_logged", F.floor((F.col("pos") - 1) / chunk).alias("chunk"), "pos", rendered.alias("out"))

    def joined(parts: DataFrame, keys: list[str], at: str) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct(at, "out")))
        return parts.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda p: p["out"]), "").alias("out"))

    chunks = joined(turns_kept, ["conv_id", "n_turns", "n_logged", "chunk"], "pos")
    return joined(chunks, ["conv_id", "n_turns", "n_logged"], "chunk").withColumnRenamed("out", "text")


SQL = r"""
WITH parts AS (
 SELECT conv_id, turn, role, text, row_number() OVER o AS pos,
  string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '') OVER o AS upto
 FROM conversations
 WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
   ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT conv_id, max(pos) AS n_turns, arg_max(upto, pos) AS text FROM parts GROUP BY conv_id),
proper AS (
 SELECT DISTINCT p.pos, p.upto FROM parts p JOIN whole w ON w.conv_id = p.conv_id AND p.pos < w.n_turns),
logged AS (SELECT min(conv_id) AS conv_id, n_turns, text, count(*) AS n_logged FROM whole GROUP BY n_turns, text)
SELECT conv_id, n_turns, n_logged, text FROM logged l
WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.pos = l.n_turns AND p.upto = l.text)
"""
