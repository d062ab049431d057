"""Benchmark decontamination with an Aho-Corasick automaton over word windows."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import trimmed

#: Bytes of words: digits, letters (A-Z become a-z) and all of other than ASCII characters.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_OUT = pa.schema([
    ("n_words", pa.int64()), ("firsts", pa.list_(pa.int64())), ("lasts", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


@functools.lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[str, bytes], ...], window: int):
    """Windows, framed by spaces, one character per byte, with their length and items."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for name, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = b" %s " % b" ".join(words[i:i + n])
            found.setdefault(key, (n, set()))[1].add(name)
    machine = ahocorasick.Automaton()
    for key, (n, names) in found.items():
        machine.add_word(key.decode("latin-1"), (n, tuple(names)))
    machine.make_automaton()
    return machine if found else None


def _scan(text: bytes, machine) -> tuple[int, list[tuple[int, int]], set[str], list[bytes]]:
    words = words_of(text)
    if machine is None or not words:
        return len(words), [], set(), words
    line = b" %s " % b" ".join(words)
    ranges, names, spaces = [], set(), None
    for end, (n, of) in machine.iter(line.decode("latin-1")):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        last = int(np.searchsorted(spaces, end)) - 1
        ranges.append((last - n + 1, last))
        names.update(of)
    return len(words), ranges, names, words


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching word ranges joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _offsets(text: bytes, ranges: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Code point offsets in the original text of the word ranges."""
    flat = np.frombuffer(text.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flat.view(np.int8), [0]))))
    # Code points before a byte: bytes that do not continue a character.
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return ([int(points[edges[2 * a]]) for a, _ in ranges], [int(points[edges[2 * b + 1]]) for _, b in ranges])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple]:
    """Items in blocks of about ``block_bytes``, collected one block at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text")
    ).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield tuple(sorted((r["item"], bytes(r["text"])) for r in block.distinct().collect()))


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, block_bytes: int = 1 << 19) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    Texts lose case (A-Z only) and everything between words; a window is ``window``
    consecutive words of an item, or the whole of a shorter one. All windows of the
    benchmark form one Aho-Corasick automaton, framed by spaces so that only whole words
    match; each text is scanned once, without a shuffle. A word inside an occurrence is
    hit. ``spans`` are the hit ranges as code point offsets in the original text.

    The benchmark is collected in blocks of at most about ``block_bytes`` of item text (one
    item larger than that is a block of its own), which bounds each automaton; a benchmark
    of several blocks makes as many passes of the same rows, one after the other, and their
    hits are merged. Null texts have no words; items without words are ignored; rows of
    ``benchmark`` with the same ``item_id`` are one item, a null one is named by the empty
    string. Other columns of ``docs`` pass through; columns named like a result are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
    kept = [c for c in docs.columns if c not in added]
    # Numbered names cannot clash, whatever the columns are called.
    renamed = {c: f"in_{i}" for i, c in enumerate(kept)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in renamed.items()])
    text = renamed[text_col]
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        first = "hits_n_words" not in rows.columns
        shape = "n_words long, firsts array<long>, lasts array<long>, starts array<long>, ends array<long>, items array<string>"
        hits = ", ".join("hits_" + part.strip() for part in shape.split(", "))
        schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if not n.startswith("hits_")) + ", " + hits
        rows = rows.mapInArrow(_scanner(rows.sparkSession.sparkContext.broadcast(items), window, text, first), schema)
    digest = F.sha2(F.array_join("hits_items", ","), 256)
    span = F.arrays_zip(F.col("hits_starts").alias("start"), F.col("hits_ends").alias("end"))
    n_hit = F.aggregate(
        F.zip_with("hits_firsts", "hits_lasts", lambda a, b: b - a + 1), F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select(
        *[F.col(n).alias(c) for c, n in renamed.items()], F.col("hits_n_words").alias("n_words"),
        n_hit.alias("n_hit"), F.size("hits_items").cast("long").alias("n_items"), digest.alias("items_sha256"),
        (F.size("hits_firsts") > 0).alias("contaminated"), span.alias("spans"),
    )


def _scanner(block, window: int, text: str, first: bool):
    """``mapInArrow`` body for one block; later blocks add to the hits of earlier ones."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(block.value, window)
        for batch in batches:
            texts = batch.column(text)
            texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
            cols: list[list] = [[] for _ in _OUT]
            for i, value in enumerate(texts):
                raw = value.as_py() or b""
                n, ranges, names, _ = _scan(raw, machine)
                if not first:
                    ranges = ranges + list(zip(batch.column("hits_firsts")[i].as_py(),
                                               batch.column("hits_lasts")[i].as_py(), strict=True))
                    names = names | set(batch.column("hits_items")[i].as_py())
                ranges = merged(ranges)
                starts, ends = _offsets(raw, ranges) if ranges else ([], [])
                row = (n, [a for a, _ in ranges], [b for _, b in ranges], starts, ends, sorted(names))
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            kept = [(f, batch.column(f.name)) for f in batch.schema if not f.name.startswith("hits_")]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in kept] + [pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)],
                names=[f.name for f, _ in kept] + [f"hits_{f.name}" for f in _OUT],
            )
    return trimmed(scan)


def plain_items_digest(names: list[str]) -> str:
    """The digest of item names, as ``items_sha256`` has it."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


SQL = r"""
WITH words AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
 SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
 FROM benchmark WHERE text IS NOT NULL),
windows AS (
 SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
 FROM (SELECT *, least(len(w), 10) AS n FROM item_words WHERE len(w) > 0)),
places AS (
 SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {'i': i, 'g': array_to_string(w[i:i + n - 1], ' ')})) AS p
 FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
 SELECT p.doc_id, p.p.i AS i, p.n, x.item FROM places p JOIN windows x ON x.n = p.n AND x.g = p.p.g),
hit_words AS (
 SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
 SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items
 FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON h.doc_id = w.doc_id LEFT JOIN hit_items t ON t.doc_id = w.doc_id
"""
