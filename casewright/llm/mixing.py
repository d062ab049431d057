"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import running_total, written

#: Characters that separate words.
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space; null has none."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    return F.size(pieces).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """Targets of sources: ``source, source_size, base, weight, target, budget``.

    ``sizes`` has ``source`` and ``source_size``. Sources in code point order, null last,
    take ``weights`` in turn. ``share`` of all sizes is dealt out by weight; a target stops
    at ``most`` times the size of its source and the excess goes to the others, again by
    weight. That fixed point is ``least(most * size, level * weight)`` with the one level
    that uses up the budget. Taking sources by rising ``size / weight``, the level is the
    largest that any number of leading, full sources leaves to the rest. ``base`` is the
    size of all sources before this one. Without any words all targets are zero.
    """
    ordered = running_total(
        sizes.select("source", "source_size", F.lit(1).cast("long").alias("one"),
                     F.col("source").isNull().alias("last")),
        [F.col("last"), F.col("source")], "one", "place", "mix-sources",
    ).drop("one")
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighed = ordered.withColumn("weight", weight)
    based = running_total(weighed, [F.col("last"), F.col("source")], "source_size", "upto", "mix-bases")
    ratio = [(F.col("source_size") / F.col("weight")), F.col("last"), F.col("source")]
    filled = running_total(based, ratio, "source_size", "filled", "mix-filled")
    filled = written(running_total(filled, ratio, "weight", "used", "mix-used"), "mix-levels")
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight_sum = whole["size"] or 0, whole["weight"] or 1
    budget = share * size
    before, used = F.col("filled") - F.col("source_size"), F.col("used") - F.col("weight")
    level = filled.agg(F.max((F.lit(budget) - most * before) / (F.lit(weight_sum) - used))).first()[0] or 0.0
    return filled.select(
        "source", "source_size", (F.col("upto") - F.col("source_size")).alias("base"), "weight",
        F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight")).alias("target"),
        F.lit(budget).alias("budget"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2,
        carry: Sequence[str] = ()) -> DataFrame:
    """Rows ``doc_id, size, source_size, target, taken, copies`` and the ``carry`` columns.

    Documents of a source are shuffled by the MD5 of their identifier. Each gets a virtual
    finish time: the words its source has queued up to its end, over the target of the
    source; a source whose target exceeds its size queues ``most`` rounds. A global range
    sort by finish time is cut where the running total of words passes the budget. Sources
    move in step, so each ends within about a document of its target; ``taken`` is words
    taken, ``copies`` how often the document is.

    Sums are formed per range of a sort, so a source that holds a third of all rows is
    spread like any other. Reruns agree: no order depends on the scan but that of rows
    alike in all columns used. Null text and null source are allowed (a null source is a
    source of its own); empty documents are taken once if their source takes anything, at
    no cost; a null identifier hashes as the empty text. An empty table gives no rows.
    """
    named = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("ticket"),
        *[F.col(c).alias(f"carry_{c}") for c in carry],
    )
    sized = written(named, "mix-sized")
    sources = written(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most
    ), "mix-targets")
    budget = sources.agg(F.max("budget")).first()[0] or 0.0

    # Empty documents queue no words; they are decided apart.
    last = F.col("source").isNull()
    queued = running_total(
        sized.where("size > 0").select("row", "doc_id", "source", "size", "ticket"),
        [last, F.col("source"), F.col("ticket"), F.col("doc_id"), F.col("size"), F.col("row")],
        "size", "upto", "mix-queued",
    )
    target = sources.select(F.col("source").alias("s"), "source_size", "base", "target")
    rounds = F.when(F.col("target") > F.col("source_size"), F.sequence(F.lit(0), F.lit(most - 1))).otherwise(
        F.array(F.lit(0)))
    ends = (
        queued.join(target, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("round", F.explode(rounds))
        .withColumn("end", (F.col("upto") - F.col("base") + F.col("round") * F.col("source_size")) / F.col("target"))
        .select("row", "source", "ticket", "doc_id", "size", "round", "end")
    )
    cut = running_total(
        ends, [F.col("end"), last, F.col("source"), F.col("ticket"), F.col("doc_id"), F.col("size"),
               F.col("row"), F.col("round")],
        "size", "total", "mix-ends",
    ).where(F.col("total") <= budget)
    copies = cut.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    out = sized.join(copies, "row", "left").join(target, F.col("source").eqNullSafe(F.col("s")))
    free = (F.col("size") == 0) & (F.col("target") > 0)
    n = F.when(free, F.lit(1)).otherwise(F.coalesce("copies", F.lit(0))).cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies"),
        *[F.col(f"carry_{c}").alias(c) for c in carry],
    )


SQL = r"""
WITH sized AS (
 SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS ticket,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM per),
weighed AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT]::BIGINT AS weight FROM placed),
whole AS (SELECT sum(source_size)::BIGINT AS size, sum(weight)::BIGINT AS weight FROM weighed),
filled AS (
 SELECT *, coalesce(sum(source_size) OVER r, 0)::BIGINT AS before, coalesce(sum(weight) OVER r, 0)::BIGINT AS used,
  coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
 FROM weighed
 WINDOW r AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
 SELECT max((1.5::DOUBLE * w.size - 2 * f.before) / (w.weight - f.used)) AS level FROM filled f, whole w),
targets AS (
 SELECT source, source_size, base, least((2 * source_size)::DOUBLE, level * weight) AS target FROM filled, level),
queued AS (
 SELECT s.*, t.source_size, t.target,
  sum(size) OVER (PARTITION BY s.source ORDER BY ticket, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
 FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size > 0),
ends AS (
 SELECT *, (upto + round * source_size) / target AS "end"
 FROM (SELECT *, unnest(CASE WHEN target > source_size THEN [0, 1] ELSE [0] END) AS round FROM queued)),
running AS (
 SELECT *, sum(size) OVER (ORDER BY "end", encode(source) NULLS LAST, ticket, doc_id, size, round
   ROWS UNBOUNDED PRECEDING) AS total FROM ends),
taken AS (
 SELECT doc_id, count(*) AS copies FROM running, whole WHERE total <= 1.5::DOUBLE * whole.size GROUP BY doc_id)
SELECT s.doc_id, s.size, t.source_size, t.target,
 (coalesce(k.copies, 0) * s.size)::BIGINT AS taken,
 CASE WHEN s.size = 0 AND t.target > 0 THEN 1 ELSE coalesce(k.copies, 0) END::BIGINT AS copies
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN taken k ON k.doc_id = s.doc_id
"""
