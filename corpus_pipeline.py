"""A training corpus from documents: known languages, one of each group of near copies, no
benchmark passages, sources mixed to weights, token files.

Every stage is a function of (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of documents. No stage depends on how a scan is
split: rows are told apart by two hashes of all their columns, and rows alike in all of
them are one document in stages that join decisions to documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewright.llm import decontaminate, language_id, mixing, near_copies, text_store, token_files
from casewright.llm.common import small_batches, table, written

_KEY = ("key_1", "key_2")


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with numbered columns, which cannot clash with an operator's, and their names."""
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def _keyed(rows: DataFrame) -> DataFrame:
    """Add two 64-bit hashes of all columns (maps have none)."""
    parts = [e for f in rows.schema if not isinstance(f.dataType, T.MapType)
             for e in (F.col(f.name).isNull(), F.col(f.name))]
    return rows.withColumns({k: F.xxhash64(F.lit(k), *parts) for k in _KEY})


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; the model learns from all rows that name theirs."""
    small_batches(spark)
    rows, names = _plain(docs)
    how = {"text_col": names["text"]}
    model = language_id.fit(rows, F.lit(True), id_col=names["doc_id"], lang_col=names["lang"], **how)
    return _restored(language_id.identify(rows, model, **how).where(~F.col("rejected")), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest identifier, of every group of near copies: chains
    of documents whose 5-word shingles have a Jaccard similarity of 0.8 or more. Operator 9 groups
    all documents first and each of its links is verified; prefix filtering finds what it misses."""
    small_batches(spark)
    rows, names = _plain(docs)
    others = [n for c, n in names.items() if c != "text"]
    groups = near_copies.near_copies(rows, id_col=names["doc_id"], text_col=names["text"], carry=others)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "no")).alias("first")
    chosen = groups.groupBy("root").agg(first).select(F.col("first.no").alias("no"))
    kept = groups.join(chosen, "no", "left_semi").select(*others, "stored", "stored_at", "stored_bytes")
    return _restored(text_store.with_texts(kept, names["text"]), names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage of ten words of the benchmark; shorter items, which may
    be a word that clean documents use, drop nothing."""
    small_batches(spark)
    rows, names = _plain(docs)
    words = F.regexp_extract_all("text", F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    items = table(spark, sf_dir, "benchmark").where(F.size(words) >= 10)
    marked = decontaminate.contamination(rows, items, text_col=names["text"])
    return _restored(marked.where(~F.col("contaminated")), names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, or not at all."""
    rows, names = _plain(docs)
    rows = _keyed(rows)
    mixed = mixing.mix(rows, id_col=names["doc_id"], text_col=names["text"], source_col=names["source"], carry=_KEY)
    times = mixed.groupBy(*_KEY).agg(F.sum("copies").alias("times")).where("times > 0")
    taken = rows.dropDuplicates(list(_KEY)).join(times, list(_KEY))
    return _restored(taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))), names)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    small_batches(spark)
    return token_files.token_table(docs, cache_bytes=32 << 20)  # workers hold what other stages need as well


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_token_files),
]

#: Fingerprints, models and tokenizers are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
