"""Queries of this package and their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.llm import (
    chat, decontaminate, exact_dedup, language_id, language_model, lexical_search, mixing, secrets, simhash,
    substring_dedup, token_alignment, token_files, toxicity,
)
from casewright.llm.common import fold, table
from casewright.plans.registry import Entry

ENTRIES: dict[str, Entry] = {}


def _query(name: str, sql: str | None = None):
    def add(run):
        ENTRIES[name] = Entry(name, run, sql)
        return run
    return add


@_query("op3_source_mix", mixing.SQL)
def _(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@_query("op5_exact_dedup", exact_dedup.SQL)
def _(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


@_query("op7_chat_format", chat.SQL)
def _(spark, sf):
    return chat.format_chats(table(spark, sf, "conversations"))


@_query("op2_decontamination", decontaminate.SQL)
def _(spark, sf):
    marked = decontaminate.contamination(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return marked.drop("text", "spans")


@_query("op6_token_files")
def _(spark, sf):
    return token_files.token_table(table(spark, sf, "documents"))


@_query("op1_language_id")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs, ~held_out)
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


@_query("op9_simhash")
def _(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents")).drop("root")


@_query("op8_toxicity")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf, "labels"), ~held_out)
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


@_query("op4_secret_scan")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.fit(docs))


@_query("op10_language_model")
def _(spark, sf):
    return language_model.score(table(spark, sf, "documents"), fold(F.col("doc_id"), 7) == 2)


@_query("op11_lexical_search", lexical_search.SQL)
def _(spark, sf):
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query("op12_substring_dedup", substring_dedup.SQL)
def _(spark, sf):
    found = substring_dedup.without_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@_query("op13_token_alignment")
def _(spark, sf):
    aligned = token_alignment.align(table(spark, sf, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return aligned.withColumn("groups_sha256", digest).drop("groups")
