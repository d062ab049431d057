"""Removal of passages that repeat across documents, found by difference-cover anchors.

A difference cover modulo a period is a set of residues such that any two positions, moved
on together by less than the period, come to stand at residues of the set. Hashes of short
anchor windows are taken only where a document's position modulo the period is in the
cover. Two occurrences of a long window then share an anchor at the same distance from
their starts, whatever their positions are. Only windows around anchors that different
texts share are extended to their whole length and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casewright.llm import text_store
from casewright.llm.common import written
from casewright.session import run_folder

#: Perfect difference sets, each a difference cover of its period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_FLAT = 1 << 16


def period_of(window: int) -> int:
    """The largest period that leaves anchors over a third of the window."""
    return max(p for p in COVERS if 3 * (window + 1 - p) > window)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = (x ^ (y * _A) ^ (y >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes, put together from runs of powers of two."""
    if len(words) < width:
        return words[:0]
    out, taken, power, step = None, 0, words, 1
    while True:
        if width & step:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - taken)
                out = _pair(out[:n], power[taken:taken + n])
            taken += step
        if 2 * step > width:
            return out[:len(words) - width + 1]
        power, step = _pair(power[:-step], power[step:]), 2 * step


def _words(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words and their 128-bit hashes (two rows of 64 bits)."""
    words = text.split()
    digest = xxhash.xxh3_128_digest
    return words, np.frombuffer(b"".join(map(digest, words)), "<u8").reshape(-1, 2).T


def anchor_places(n: int, period: int) -> np.ndarray:
    """Positions below ``n`` whose residue is in the cover."""
    cover = np.array(COVERS[period], np.int64)
    return np.sort((np.arange(-(-max(n, 0) // period))[:, None] * period + cover).ravel(), kind="stable")[
        :int((np.arange(max(n, 0) % period)[:, None] == cover).sum()) + len(cover) * (max(n, 0) // period)]


def _read(docs: DataFrame, id_col: str, text_col: str, window: int, period: int) -> DataFrame:
    """One row per document: place in the text store, digest of the words, anchors."""
    folder = run_folder(docs.sparkSession, "repeat-texts")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 40
        with text_store.TextWriter(folder) as writer:
            for batch in batches:
                texts = [t.as_py() for t in batch.column(1)]
                counts, wholes, anchors = [], [], []
                for text in texts:
                    words, hashes = _words(text)
                    counts.append(len(words))
                    wholes.append(hashlib.sha256(b" ".join(words)).digest())
                    found = rolled(hashes[0], window + 1 - period) if len(words) >= window else hashes[0][:0]
                    anchors.append(found[anchor_places(len(found), period)].view(np.int64))
                places = list(zip(*writer.add(texts), strict=True)) or [[], [], []]
                at = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.arange(no, no + len(texts))), pa.array(counts, pa.int64()),
                     pa.array(wholes, pa.binary()), pa.array(places[0], pa.string()), pa.array(places[1], pa.int64()),
                     pa.array(places[2], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int64), *anchors])))],
                    names=["doc_id", "no", "n_words", "whole", "stored", "stored_at", "stored_bytes", "anchors"])
                no += len(texts)

    schema = f"doc_id {kind.simpleString()}, no long, n_words long, whole binary, {text_store.PLACE}, anchors array<long>"
    return written(rows.mapInArrow(run, schema), "repeat-rows")


def _shared_anchors(rows: DataFrame) -> DataFrame:
    """``no, anchors``: which anchors of a row another text has too, by their number."""
    # Copies of a text do not make its anchors shared: they are told apart by word digest.
    text = F.conv(F.hex(F.substring("whole", 1, 8)), 16, -10).cast("long")
    placed = rows.select("no", text.alias("same"), F.posexplode("anchors").alias("at", "anchor"))
    several = placed.groupBy("anchor").agg(F.min("same").alias("a"), F.max("same").alias("b")).where("a != b").select("anchor")
    # Written, so that the join reads plain exchanges, which adaptive execution splits where a key is hot.
    several = written(several, "repeat-anchors")
    return placed.select("no", "at", "anchor").join(several, "anchor", "left_semi").groupBy("no").agg(
        F.collect_set("at").alias("anchors"))


def _windows(marked: DataFrame, window: int, period: int) -> DataFrame:
    """``h1, h2, doc_id, no, start`` of the windows around shared anchors, with 128-bit hashes."""
    arrow_kind = to_arrow_type(marked.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            words, hashes = _words(text_store.fetch(row["stored"], row["stored_at"], row["stored_bytes"]))
            n = len(words) - window + 1
            places = anchor_places(len(words) - (window - period), period)[row["anchors"]]
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, np.maximum(places - period + 1, 0), 1)
            np.add.at(edge, np.minimum(places + 1, n), -1)
            starts = np.flatnonzero(np.cumsum(edge)[:n] > 0)
            lanes = [rolled(h, window)[starts].view(np.int64) for h in hashes]
            for a in range(0, len(starts), _FLAT):
                own = starts[a:a + _FLAT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lanes[0][a:a + _FLAT]), pa.array(lanes[1][a:a + _FLAT]),
                     pa.array([row["doc_id"]] * len(own), arrow_kind), pa.array(np.full(len(own), row["no"])),
                     pa.array(own.astype(np.int32))],
                    names=["h1", "h2", "doc_id", "no", "start"])

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, no long, start int")


def _joined(window: int):
    """Sorted starts of windows as the word ranges they cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for starts in batch.column(1):
                s = starts.values.to_numpy(zero_copy_only=False)
                edges = np.flatnonzero(np.diff(s) > window) + 1
                firsts, lasts = s[np.r_[0, edges]], s[np.r_[edges - 1, len(s) - 1]]
                spans.append([{"first": int(a), "end": int(b) + window} for a, b in zip(firsts, lasts, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))],
                names=["same_as", "spans"])
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per input row: ``doc_id, n_words, spans`` and the place of its text in the store.

    Words are runs of other characters than ASCII white space, unchanged. ``spans`` are the
    word ranges (``first, end`` exclusive) that windows of ``window`` consecutive words cover
    whose word sequence also starts in a document with a smaller identifier. Windows are
    judged on the input. All such windows are found: an anchor window of ``window + 1 -
    period`` words is shared by any two occurrences (see above); whole windows are compared
    by 128-bit hashes.

    Texts of the same words are one class: its smallest identifier is compared with other
    texts, larger ones repeat it wholly. Anchors and windows that very many documents share
    are counted on the map side and never gathered. Null texts have no words; a null
    identifier is larger than any other and no smaller than another null one; rows alike in
    identifier are no copies of each other; an empty table gives no rows; other columns
    are ignored.
    """
    period = period_of(window)
    rows = _read(docs, id_col, text_col, window, period)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "no")
    classes = rows.where(F.col("n_words") >= window).groupBy("whole").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = written(classes.select("whole", F.col("first.doc_id").alias("least"), F.col("first.no").alias("same_as"), "n"), "repeat-classes")
    meta = rows.select("no", "doc_id", *[c.split()[0] for c in text_store.PLACE.split(", ")])
    # Spark knows lists only by the size of their file, so that joins with them are not left to its choice.
    firsts = classes.select(F.col("same_as").alias("no"))
    marked = meta.join(firsts.hint("merge"), "no", "left_semi").join(_shared_anchors(rows).hint("merge"), "no")
    marked = written(text_store.in_order(marked), "repeat-marked")

    found = _windows(marked, window, period)
    several = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND least IS NOT NULL").select("h1", "h2", "least")
    several = written(several, "repeat-windows")
    # A document becomes very many windows, of which Spark knows the size before only: they must not be the side it broadcasts.
    earlier = F.expr("w.h1 = s.h1 AND w.h2 = s.h2 AND (w.doc_id IS NULL OR w.doc_id > s.least)")
    repeats = found.alias("w").join(several.alias("s"), earlier, "left_semi").groupBy("no").agg(
        F.sort_array(F.collect_list("start")).alias("starts"))
    spans = written(repeats.select(F.col("no").alias("same_as"), "starts").mapInArrow(
        _joined(window), "same_as long, spans array<struct<first:int,end:int>>"), "repeat-spans")

    # A copy repeats its class wholly; any other row has the spans of the class's first row.
    copies = classes.where("n > 1").select("whole", "least", "same_as")
    judged = rows.drop("anchors").join(copies, "whole", "left")
    copy = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
    # Copies have no spans to join: keys of their own, so that they do not meet in one task.
    judged = judged.withColumn("copy", F.coalesce(copy, F.lit(False))).withColumn(
        "same_as", F.when(~F.col("copy"), F.coalesce("same_as", "no")).otherwise(-1 - F.col("no")))
    all_words = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<first:int,end:int>>")
    return judged.join(spans.hint("merge"), "same_as", "left").withColumn(
        "spans", F.when(F.col("copy"), all_words).otherwise(F.coalesce("spans", none))).select(
        "doc_id", "n_words", "spans", "stored", "stored_at", "stored_bytes")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``doc_id, n_words, spans, kept``: what ``repeated_spans`` finds and the words left, joined by one space."""
    rows = text_store.in_order(repeated_spans(docs, id_col, text_col, window))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part, kept = batch.slice(a, 256), []
                for row in part.select(["spans", "stored", "stored_at", "stored_bytes"]).to_pylist():
                    words = text_store.fetch(row["stored"], row["stored_at"], row["stored_bytes"]).split()
                    for span in reversed(row["spans"]):
                        del words[span["first"]:span["end"]]
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("doc_id", "n_words", "spans")], pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "spans", "kept"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, spans array<struct<first:int,end:int>>, kept string")


SQL = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
 SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split WHERE len(w) >= 50)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g HAVING count(*) > 1),
covered AS (
 SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
 FROM (SELECT x.doc_id, x.i FROM windows x JOIN firsts f ON f.g = x.g AND x.doc_id > f.least)),
kept AS (
 SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.j) AS words, count(*)::BIGINT AS n
 FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM split) s
 LEFT JOIN covered c ON c.doc_id = s.doc_id AND c.j = s.j WHERE c.j IS NULL GROUP BY s.doc_id)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, (len(s.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
 sha256(coalesce(k.words, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""
