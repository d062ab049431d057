"""Ranked lexical search over bit-sliced Bloom signatures.

The index has one row per block of documents with similar numbers of distinct terms. A
block's signature is a bit matrix, stored by slices: slice ``i`` is a bitmap with one bit per
document, set if the Bloom filter of that document has bit ``i``. Filters hold (term, level)
for every level up to the term's frequency, so the slices of a term say which documents
may hold it and how often at most: never too little, sometimes too much. Weighted sums of
these give an upper bound of every document's score, and documents whose bound cannot
reach the best ones are excluded without looking at their text. All others are scored
exactly from their whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from casewright.llm import text_store
from casewright.llm.common import written
from casewright.session import run_folder

#: Letters and digits in lower case, bytes of other characters as they are, all else a space.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: Frequencies a filter tells apart: 1, 2, 3, 4, then two steps for each doubling.
LEVELS = np.array([1, 2, 3] + [x for k in range(2, 40) for x in (1 << k, 3 << (k - 1))], np.int64)
_LONGS = ("array<long>", pa.list_(pa.int64()))
#: Columns of the index beside the identifiers.
_INDEX = {
    "width": ("long", pa.int64()), "total": ("long", pa.int64()), "n": _LONGS, "most": _LONGS, "slices": ("binary", pa.binary()),
    "stored": ("string", pa.string()), "stored_at": _LONGS, "stored_bytes": ("array<int>", pa.list_(pa.int32())),
    "terms": _LONGS, "holders": ("array<int>", pa.list_(pa.int32())),
}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _hashes(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, 11) for w in words], np.uint64)


def _slots(hashes: np.ndarray, level: np.ndarray | int, width: int, probes: int) -> np.ndarray:
    """Slices of (term, level): ``probes`` columns."""
    h = (hashes ^ (np.asarray(level, np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _ODD
    h ^= h >> np.uint64(32)
    step = (h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(17) | np.uint64(1)
    return ((h[:, None] + np.arange(probes, dtype=np.uint64) * step[:, None]) % np.uint64(width)).astype(np.int64)


def _signature(found: list[tuple[np.ndarray, np.ndarray]], width: int, probes: int) -> bytes:
    """Slices of documents given as (term hashes, frequencies)."""
    bits = np.zeros((width, len(found)), np.uint8)
    for d, (hashes, counts) in enumerate(found):
        reach = np.searchsorted(LEVELS, counts, "right")
        level = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        bits[_slots(np.repeat(hashes, reach), level, width, probes).ravel(), d] = 1
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def _cut(sizes: list[int], most_docs: int, most_bits: int, bits: int) -> Iterator[tuple[int, int]]:
    """Blocks of rising ``sizes`` in which no document has over twice the keys of another."""
    a = 0
    for i, n in enumerate(sizes):
        if i > a and (i - a >= most_docs or n > max(64, 2 * sizes[a]) or n * bits * (i - a + 1) > most_bits):
            yield a, i
            a = i
    if a < len(sizes):
        yield a, len(sizes)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 16, probes: int = 6,
                block_docs: int = 1024, gather_bytes: int = 16 << 20, block_bits: int = 1 << 25) -> DataFrame:
    """The index of ``docs`` as a Parquet table in the shared folder, one row per block.

    Terms are maximal runs of letters, digits and non-ASCII characters of the whole text,
    A-Z in lower case. A filter has ``bits`` bits for each of its (term, level) keys. A task
    gathers ``gather_bytes`` of text, orders it by the number of keys and cuts blocks of at
    most ``block_docs`` documents; no row depends on more. Whole texts go to a text store,
    by which exact scores read those of few documents. ``terms`` and ``holders`` count the
    documents that hold a term, by 64-bit hash, for what was gathered together. Null texts
    have no terms; such documents are not in the index. Identifiers may be null or repeated.
    """
    folder = run_folder(docs.sparkSession, "search-texts")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    kind = rows.schema["doc_id"].dataType
    schema = f"doc_ids array<{kind.simpleString()}>, " + ", ".join(f"{n} {t}" for n, (t, _) in _INDEX.items())
    arrow_kind = to_arrow_type(kind)

    def blocks(ids: list[pa.Scalar], texts: list[bytes], counted: list[Counter], writer) -> Iterator[pa.RecordBatch]:
        hashed = [(_hashes(c), np.fromiter(c.values(), np.int64, len(c))) for c in counted]
        sizes = [int(np.searchsorted(LEVELS, n, "right").sum()) for _, n in hashed]
        order = sorted(range(len(ids)), key=lambda i: sizes[i])
        held = np.unique(np.concatenate([h for h, _ in hashed]), return_counts=True)
        for a, b in _cut([sizes[i] for i in order], block_docs, block_bits, bits):
            own = order[a:b]
            width = max(64, bits * sizes[own[-1]])
            places = writer.add([texts[i] for i in own])
            n = [int(hashed[i][1].sum()) for i in own]
            row = {"width": width, "total": sum(n), "n": n, "most": [int(hashed[i][1].max()) for i in own],
                   "slices": _signature([hashed[i] for i in own], width, probes), "stored": writer.path,
                   "stored_at": [p[1] for p in places], "stored_bytes": [p[2] for p in places],
                   "terms": held[0].view(np.int64), "holders": held[1].astype(np.int32)}
            held = (held[0][:0], held[1][:0])  # once for all blocks
            yield pa.RecordBatch.from_arrays(
                [pa.array([[ids[i].as_py() for i in own]], pa.list_(arrow_kind)),
                 *[pa.array([row[c]], t) for c, (_, t) in _INDEX.items()]], names=["doc_ids", *_INDEX])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, counted, size = [], [], [], 0
        with text_store.TextWriter(folder) as writer:
            for batch in batches:
                for name, value in zip(batch.column(0), batch.column(1), strict=True):
                    text = value.as_py()
                    if not (count := Counter(terms(text))):
                        continue
                    ids.append(name)
                    texts.append(text)
                    counted.append(count)
                    size += len(text)
                    if size >= gather_bytes:
                        yield from blocks(ids, texts, counted, writer)
                        ids, texts, counted, size = [], [], [], 0
            if ids:
                yield from blocks(ids, texts, counted, writer)

    return written(rows.mapInArrow(run, schema), "search-index")


class Queries:
    """Items of one block of queries with the weights of their terms."""

    def __init__(self, items: list[tuple[str, bytes]]):
        counted = [(key, Counter(terms(text))) for key, text in items]
        self.items = [(key, c) for key, c in counted if c]
        self.terms = sorted({t for _, c in self.items for t in c})
        self.hashes = _hashes(self.terms)
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.of = [(np.array([self.place[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for _, c in self.items]
        self.weights = np.zeros(len(self.terms), np.int64)
        self.n_docs = self.n_terms = 0

    def weigh(self, holders: dict[int, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(h, 0) + 1)))
                                 for h in self.hashes.view(np.int64).tolist()], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length part of each document's scores."""
        return 75 + 25 * n * self.n_docs // self.n_terms


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def upper_bounds(queries: Queries, slices: np.ndarray, m: np.ndarray, most: np.ndarray, probes: int) -> np.ndarray:
    """For each item and document of a block a score that the exact one does not exceed."""
    width, n = len(slices), len(m)
    may = np.zeros((len(queries.terms), n), bool)
    for a in range(0, len(may), 512):
        slots = _slots(queries.hashes[a:a + 512], 0, width, probes)
        both = slices[slots[:, 0]]
        for k in range(1, probes):
            both = both & slices[slots[:, k]]
        may[a:a + 512] = np.unpackbits(both, axis=1, count=n, bitorder="little")
    term, doc = np.nonzero(may)
    reach, active = np.zeros(len(term), np.int64), np.arange(len(term))
    for level in range(1, len(LEVELS)):
        active = active[most[doc[active]] >= LEVELS[level]]
        if not len(active):
            break
        slots = _slots(queries.hashes[term[active]], level, width, probes)
        at, bit = doc[active] >> 3, (doc[active] & 7).astype(np.uint8)
        seen = np.ones(len(active), bool)
        for k in range(probes):
            seen &= (slices[slots[:, k], at] >> bit & 1).astype(bool)
        active = active[seen]
        reach[active] = level
    tf = np.minimum(np.append(LEVELS[1:], 2 * LEVELS[-1])[reach] - 1, most[doc])
    gains = np.zeros(may.shape, np.int64)
    gains[term, doc] = queries.weights[term] * _gain(tf, m[doc])
    bounds = np.zeros((len(queries.items), n), np.int64)
    for i, (own, times) in enumerate(queries.of):
        for t, r in zip(own.tolist(), times.tolist(), strict=True):
            bounds[i] += gains[t] if r == 1 else r * gains[t]
    return bounds


def exact_counts(queries: Queries, text: bytes) -> np.ndarray:
    """Frequencies of the queries' terms in a whole text."""
    tf = np.zeros(len(queries.terms), np.int64)
    for word, n in Counter(terms(text)).items():
        if (i := queries.place.get(word)) is not None:
            tf[i] = n
    return tf


def _search(index: DataFrame, shared, top: int, probes: int, kind) -> DataFrame:
    """The ``top`` documents of each item within each task's part of the index."""
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best: list[list] = [[] for _ in queries.items]  # (-score, null id, id), in order
        for row in (r for b in batches for r in b.to_pylist()):
            n = np.array(row["n"], np.int64)
            m, most = queries.lengths(n), np.array(row["most"], np.int64)
            slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
            bounds = upper_bounds(queries, slices, m, most, probes)
            seen: dict[int, np.ndarray] = {}
            for i, (own, times) in enumerate(queries.of):
                least = -best[i][-1][0] if len(best[i]) == top else 1
                open_docs = np.flatnonzero(bounds[i] >= least)
                for d in open_docs[np.argsort(-bounds[i][open_docs], kind="stable")].tolist():
                    if len(best[i]) == top and bounds[i][d] < -best[i][-1][0]:
                        break  # excluded, and so are all that follow
                    if d not in seen:
                        seen[d] = exact_counts(queries, text_store.fetch(row["stored"], row["stored_at"][d], row["stored_bytes"][d]))
                    score = int((times * queries.weights[own] * _gain(seen[d][own], m[d])).sum())
                    if score > 0:
                        name = row["doc_ids"][d]
                        best[i] = sorted([*best[i], (-score, name is None, name)])[:top]
        out = [(key, s, name) for (key, _), rows in zip(queries.items, best, strict=True) for s, _, name in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in out], pa.string()), pa.array([-s for _, s, _ in out], pa.int64()),
             pa.array([n for _, _, n in out], arrow_kind)], names=["query", "score", "doc_id"])

    schema = T.StructType().add("query", "string").add("score", "long").add("doc_id", kind)
    return index.select("doc_ids", "width", "n", "most", "slices", "stored", "stored_at", "stored_bytes").mapInArrow(run, schema)


def _holders(index: DataFrame, shared) -> DataFrame:
    """``term, holders``: how many documents hold the queries' terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.sort(shared.value.hashes.view(np.int64))
        for batch in batches:
            term, n = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            at = np.minimum(np.searchsorted(asked, term), len(asked) - 1)
            own = asked[at] == term
            yield pa.RecordBatch.from_arrays([pa.array(term[own]), pa.array(n[own].astype(np.int64))], names=["term", "holders"])

    parts = index.where(F.size("terms") > 0).select("terms", "holders").mapInArrow(run, "term long, holders long")
    return parts.groupBy("term").agg(F.sum("holders").alias("holders"))


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = 20, block_bytes: int = 1 << 19,
           probes: int = 6, **index_how) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each row of ``queries`` with a score above 0.

    N counts the documents with at least one term, L all their terms, n those of one
    document, df the holders of a term, tf its occurrences. A term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``; with ``m = 75 + (25 n N) div L`` the score is the
    sum of ``w * (10^9 tf div (1000 tf + 12 m))`` over the item's terms, repeats included.
    Equal scores rank by ascending identifier, a null one last.

    Queries are collected in blocks of about ``block_bytes`` of text (a longer one is a block
    of its own), which bounds what is broadcast and the ``top`` rows each task returns an
    item; every block reads the index once. Within a task a document is excluded only if
    its bound is below the ``top``-th best exact score so far, so results do not depend on how
    the index is split. Null texts and those without terms give no rows; repeated rows of
    ``docs`` take a place each, repeated rows of ``queries`` repeat their results; empty tables
    give none; other columns are ignored.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col, probes=probes, **index_how)
    kind = docs.schema[id_col].dataType
    whole = index.agg(F.sum(F.size("n")).alias("docs"), F.sum("total").alias("terms")).first()
    items = queries.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL").withColumn(
        "query", F.sha2("text", 256))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    found = spark.createDataFrame([], T.StructType().add("query", "string").add("score", "long").add("doc_id", kind))
    for k in range(n_blocks if whole["docs"] else 0):
        own = items.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == k).select("query", F.col("text").cast("binary").alias("text"))
        block = Queries([(r["query"], bytes(r["text"])) for r in own.dropDuplicates(["query"]).collect()])
        if not block.items:
            continue
        asked = spark.sparkContext.broadcast(block)
        block.weigh({r["term"]: r["holders"] for r in _holders(index, asked).collect()}, whole["docs"], whole["terms"])
        shared = spark.sparkContext.broadcast(block)
        found = found.union(written(_search(index, shared, top, probes, kind), "search-found"))
        shared.unpersist()
        asked.unpersist()
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return items.select("item_id", "query").join(ranked, "query").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH terms AS (
 SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, len(t)::BIGINT AS n, t FROM terms WHERE len(t) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sized),
counted AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM sized) GROUP BY ALL),
asked AS (
 SELECT item_id, term, count(*)::BIGINT AS times FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
holders AS (SELECT term, count(*)::BIGINT AS df FROM counted GROUP BY term),
weights AS (
 SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM holders, whole),
scores AS (
 SELECT a.item_id, c.doc_id, sum(a.times * w.w * ((1000000000 * c.tf) //
  (1000 * c.tf + 12 * (100 - 25 + (25 * c.n * whole.docs) // whole.all_terms))))::BIGINT AS score
 FROM asked a JOIN counted c ON c.term = a.term JOIN weights w ON w.term = a.term, whole GROUP BY a.item_id, c.doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""
