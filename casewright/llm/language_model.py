"""Bigram language model in Elias-Fano tries, trained and queried shard by shard.

Documents are cut into chunks. A chunk sends each shard its distinct words and word pairs,
with training counts; the shard merges what all chunks send, builds a trie of the training
pairs, and answers every chunk from it. No step holds the whole model, nothing is counted
on a sample, and what moves are distinct pairs of chunks, not tokens.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.common import written
from casewright.llm.elias_fano import SUCCESSOR_BITS, Trie, quantise, restore
from casewright.session import run_folder

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words of a chunk that occur less often are not looked at when contexts are split.
_HEAVY = 64
#: Absolute discount of pair counts.
_DISCOUNT = 0.75
_CHUNK = ("chunk long, ids array<long>, held array<boolean>, lengths binary, tokens binary, words binary, "
          "n_words long, n_pairs long, heavy_words array<long>, heavy_counts array<long>")
_MESSAGE = "shard int, kind int, chunk long, words binary, counts binary, sizes binary, successors binary, pairs binary"
_ANSWER = ("shard int, kind int, chunk long, counts binary, sizes binary, codes binary, "
           "n long, v long, n1 long, n2 long, hot array<long>, hot_sizes array<long>")


def pack(values: np.ndarray, width: int) -> bytes:
    """Integers of ``width`` bytes, byte plane by byte plane, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return full.view("<u8").ravel()


def _signed(x: np.ndarray) -> list[int]:
    return x.astype(np.uint64).view(np.int64).tolist()


class _Gatherer:
    """Collects documents of a task into the row of one chunk."""

    def __init__(self):
        self.local: dict[bytes, int] = {b"": 0}  # the end of a document
        self.tokens: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.held: list[bool] = []
        self.n = 0

    def add(self, name: int | None, held: bool, text: bytes) -> None:
        local = self.local
        found = [local.setdefault(w, len(local)) for w in text.translate(_LOWER).split()]
        found.append(0)
        self.tokens.append(np.array(found, np.uint32))
        self.ids.append(name)
        self.held.append(held)
        self.n += len(found)

    def row(self) -> dict:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.local], np.uint64)
        lengths = np.array([len(t) for t in self.tokens])
        tokens = np.concatenate(self.tokens)
        trained = np.bincount(tokens[np.repeat(~np.array(self.held), lengths)], minlength=len(hashes))
        heavy = np.flatnonzero(trained >= _HEAVY)
        return {
            "chunk": uuid.uuid4().int >> 65, "ids": self.ids, "held": self.held, "lengths": pack(lengths, 8),
            "tokens": pack(tokens, 4), "words": pack(hashes, 8), "n_words": len(hashes),
            "n_pairs": len(np.unique(_pair_keys(tokens, lengths, len(hashes)))),
            "heavy_words": _signed(hashes[heavy]), "heavy_counts": trained[heavy].tolist(),
        }


def _pair_keys(tokens: np.ndarray, lengths: np.ndarray, n_words: int) -> np.ndarray:
    """(word before, word) of every token as one number; the end stands before a first word."""
    before = np.concatenate(([0], tokens[:-1])).astype(np.uint64)
    before[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = 0
    return before * np.uint64(n_words) + tokens


def gather(docs: DataFrame, held_out: Column, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """Chunks of about ``chunk_tokens`` tokens or one longer document, as a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _CHUNK.split(", ")]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3, *[pa.int64()] * 2,
                 *[pa.list_(pa.int64())] * 2]

        def done(g):
            row = g.row()
            return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)], names=names)

        current = _Gatherer()
        for batch in batches:
            for name, held, text in zip(*[batch.column(c) for c in ("doc_id", "held_out", "text")], strict=True):
                current.add(name.as_py(), held.as_py(), text.as_py() or b"")
                if current.n >= chunk_tokens:
                    yield done(current)
                    current = _Gatherer()
        if current.n:
            yield done(current)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(run, _CHUNK), "lm-chunks")


class _Layout:
    """How a chunk's words and pairs are dealt to shards; made alike for asking and for reading answers."""

    def __init__(self, row: dict, shards: int, hot: np.ndarray):
        self.hashes = unpack(row["words"], 8)
        self.lengths = unpack(row["lengths"], 8).astype(np.int64)
        self.tokens = unpack(row["tokens"], 4).astype(np.int64)
        self.trained = np.repeat(~np.array(row["held"], bool), self.lengths)
        n = len(self.hashes)
        self.by_hash = np.argsort(self.hashes)
        rank = np.empty(n, np.int64)
        rank[self.by_hash] = np.arange(n)
        self.words = self.hashes[self.by_hash]
        self.ranked = rank[self.tokens]
        before = np.concatenate(([0], self.tokens[:-1]))
        before[np.concatenate(([0], np.cumsum(self.lengths)[:-1]))] = 0
        keys = rank[before].astype(np.uint64) * np.uint64(n) + self.ranked.astype(np.uint64)
        # Distinct pairs, and which one each token is.
        self.pairs, self.pair_of = np.unique(keys, return_inverse=True)
        self.context = (self.pairs // np.uint64(n)).astype(np.int64)
        self.successor = self.words[(self.pairs % np.uint64(n)).astype(np.int64)] >> np.uint64(64 - SUCCESSOR_BITS)
        is_hot = np.isin(self.words, hot)
        self.word_shard = ((self.words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        spread = (self.successor >> np.uint64(SUCCESSOR_BITS - 32)) * np.uint64(shards) >> np.uint64(32)
        self.hot_word = is_hot
        self.is_hot = is_hot[self.context]
        pair_shard = np.where(self.is_hot, spread.astype(np.int64), self.word_shard[self.context])
        # Pairs by (kind, shard, context, successor); the order of messages and of answers.
        self.order = np.lexsort((self.pairs, pair_shard, self.is_hot))
        self.pair_shard = pair_shard


def _slices(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of each run."""
    if len(sorted_keys):
        edges = np.flatnonzero(np.diff(sorted_keys)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(sorted_keys)], strict=True):
            yield int(sorted_keys[a]), a, b


def _messages(row: dict, shards: int, hot: np.ndarray) -> Iterator[dict]:
    lay = _Layout(row, shards, hot)
    word_counts = np.bincount(lay.ranked[lay.trained], minlength=len(lay.words))
    pair_counts = np.bincount(lay.pair_of[lay.trained], minlength=len(lay.pairs))
    normal, hots = lay.order[:(~lay.is_hot).sum()], lay.order[(~lay.is_hot).sum():]
    sizes = np.bincount(lay.context[normal], minlength=len(lay.words))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for shard, a, b in _slices(lay.word_shard):
        own = normal[ends[a]:ends[b]]
        yield {"shard": shard, "kind": 0, "chunk": row["chunk"], "words": pack(lay.words[a:b], 8),
               "counts": pack(word_counts[a:b], 8), "sizes": pack(sizes[a:b], 4),
               "successors": pack(lay.successor[own], 5), "pairs": pack(pair_counts[own], 8)}
    for shard, a, b in _slices(lay.pair_shard[hots]):
        own = hots[a:b]
        contexts, begins = np.unique(lay.context[own], return_index=True)
        yield {"shard": shard, "kind": 1, "chunk": row["chunk"], "words": pack(lay.words[contexts], 8),
               "counts": pack(np.zeros(len(contexts)), 8), "sizes": pack(np.diff(np.append(begins, len(own))), 4),
               "successors": pack(lay.successor[own], 5), "pairs": pack(pair_counts[own], 8)}


def _rows(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [p.split(" ") for p in schema.split(", ")]
    return pa.table({n: pa.array([r.get(n) for r in rows], kinds[k]) for n, k in fields})


def _answer(folder: str, keep: bool):
    """Merge all messages of a shard, build and map its trie, answer each chunk from it."""
    def run(table: pa.Table) -> pa.Table:
        got = table.to_pylist()
        shard, kind = got[0]["shard"], got[0]["kind"]
        words = [unpack(m["words"], 8) for m in got]
        sizes = [unpack(m["sizes"], 4).astype(np.int64) for m in got]
        vocabulary, of = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.zeros(len(vocabulary), np.int64)
        np.add.at(counts, of, np.concatenate([unpack(m["counts"], 8) for m in got]).astype(np.int64))
        keys = (np.repeat(of.astype(np.uint64), np.concatenate(sizes)) << np.uint64(SUCCESSOR_BITS)) | np.concatenate(
            [unpack(m["successors"], 5) for m in got])
        pairs, pair_of = np.unique(keys, return_inverse=True)
        totals = np.zeros(len(pairs), np.int64)
        np.add.at(totals, pair_of, np.concatenate([unpack(m["pairs"], 8) for m in got]).astype(np.int64))

        # The trie holds what training has seen. Parts of a split context are not
        # normalised here: no shard has its whole count.
        seen = totals > 0
        place = (pairs >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        present, n_successors = np.unique(place[seen], return_counts=True)
        whole = np.bincount(place[seen], weights=totals[seen], minlength=len(vocabulary)) if kind == 0 else np.ones(len(vocabulary))
        log_p = np.log10((totals[seen] - _DISCOUNT) / whole[place[seen]])
        path = f"{folder}/shard-{shard:07d}-{kind}-{uuid.uuid4().hex}.trie"
        mask = np.uint64((1 << SUCCESSOR_BITS) - 1)
        Trie.write(path, vocabulary[present], n_successors, pairs[seen] & mask, quantise(log_p))
        trie = Trie.open(path)
        at, n_after = trie.contexts(vocabulary)
        known = at[place] >= 0
        codes = np.zeros(len(pairs), np.uint16)
        codes[known] = trie.codes(at[place[known]], pairs[known] & mask)
        del trie
        if not keep:
            _remove(path)

        out, word_at, pair_at = [], 0, 0
        for m, w, s in zip(got, words, sizes, strict=True):
            own, ask = of[word_at:word_at + len(w)], pair_of[pair_at:pair_at + s.sum()]
            word_at, pair_at = word_at + len(w), pair_at + int(s.sum())
            out.append({"shard": shard, "kind": kind, "chunk": m["chunk"], "codes": pack(codes[ask], 2)} | ({
                "counts": pack(counts[own], 8), "sizes": pack(n_after[own], 5)} if kind == 0 else {}))
        stats = {"shard": shard, "kind": kind, "n": int(counts.sum()), "v": int((counts > 0).sum()),
                 "n1": int((counts == 1).sum()), "n2": int((counts == 2).sum())}
        if kind == 1:
            stats |= {"hot": _signed(vocabulary), "hot_sizes": n_after.tolist()}
        return _rows([*out, stats], _ANSWER)
    return run


def _remove(path: str) -> None:
    from pyarrow import fs

    from casewright.llm.shared_files import _resolve
    store, inner = _resolve(path)
    if isinstance(store, fs.LocalFileSystem):
        os.unlink(inner)
    else:
        store.delete_file(inner)


def _score(shards: int, hot: np.ndarray, hot_sizes: np.ndarray, n: int, v: int, n1: int, n2: int):
    """Scores of a chunk's documents from the answers of all shards."""
    cut = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    unknown = cut * v / n if n else 1.0

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for row in chunks.to_pylist():
            lay = _Layout(row, shards, hot)
            got = sorted(answers.to_pylist(), key=lambda a: (a["kind"], a["shard"]))
            counts = np.concatenate([unpack(a["counts"], 8) for a in got if a["kind"] == 0]).astype(np.float64)
            after = np.concatenate([unpack(a["sizes"], 5) for a in got if a["kind"] == 0]).astype(np.float64)
            codes = np.zeros(len(lay.pairs), np.uint16)
            codes[lay.order] = np.concatenate([unpack(a["codes"], 2) for a in got]).astype(np.uint16)
            if len(hot):
                after[lay.hot_word] = hot_sizes[np.searchsorted(hot, lay.words[lay.hot_word])]
            single = np.where(counts > 0, np.maximum(counts - cut, 0) / max(n, 1), unknown)
            of_context = counts[lay.context]
            seen = restore(codes) / np.where(lay.is_hot & (of_context > 0), of_context, 1.0)
            back = np.where(of_context > 0, _DISCOUNT * after[lay.context] / np.maximum(of_context, 1), 1.0)
            word = (lay.pairs % np.uint64(len(lay.words))).astype(np.int64)
            log_p = np.log10(np.minimum(seen + back * single[word], 1.0))
            base = np.log10((counts + 1) / (n + v + 1))
            begins = np.concatenate(([0], np.cumsum(lay.lengths)[:-1]))
            out["doc_id"] += row["ids"]
            out["held_out"] += row["held"]
            out["n_tokens"] += lay.lengths.tolist()
            out["n_known"] += np.add.reduceat((counts > 0).astype(np.int64)[lay.ranked], begins).tolist()
            out["base_score"] += np.add.reduceat(base[lay.ranked], begins).tolist()
            out["score"] += np.add.reduceat(log_p[lay.pair_of], begins).tolist()
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({k: pa.array(x, t) for (k, x), t in zip(out.items(), kinds, strict=True)})
    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          chunk_tokens: int = 2_000_000, shard_pairs: int = 2_000_000, model_folder: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Trained on the rows where ``held_out`` is not true. Tokens are runs of other characters
    than ASCII white space, A-Z in lower case, then one end; null texts are empty. The base
    score adds one to each count. The model interpolates discounted pair counts with
    discounted single counts; the mass of unknown words is what the discount takes from
    known ones, and the end stands before a first word. ``model_folder`` keeps the tries,
    one file per shard; by default each is removed when its shard has been answered.

    Words are known by 64-bit hashes, successors by 40 bits within their context. A shard
    has about ``shard_pairs`` pairs. A context with so many tokens that it would fill an
    eighth of a shard (8 * tokens / shard_pairs at most) is split by successors. A chunk and
    a shard exchange one message, so both sizes should grow with the memory of executors
    where there are very many of either. Chunks are written before use, so their cut, which
    depends on the scan, is fixed. An empty table gives no rows; identifiers may be null or
    repeated; other columns are ignored.
    """
    spark = docs.sparkSession
    chunks = gather(docs, held_out, id_col, text_col, chunk_tokens)
    shards = max(1, -(-(chunks.agg(F.sum("n_pairs")).first()[0] or 0) // shard_pairs))
    heavy = chunks.select(F.explode(F.arrays_zip(F.col("heavy_words").alias("w"), F.col("heavy_counts").alias("n"))).alias("x"))
    hot = [r["w"] for r in heavy.groupBy("x.w").agg(F.sum("x.n").alias("n")).where(
        (F.col("n") > shard_pairs // 8) & F.lit(shards > 1)).select("w").collect()]
    hot = np.sort(np.array(hot, np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(hot)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _rows(list(_messages(row, shards, shared.value)), _MESSAGE).to_batches()

    folder = model_folder or run_folder(spark, "lm-tries")
    answers = written(chunks.mapInArrow(ask, _MESSAGE).groupBy("shard", "kind").applyInArrow(
        _answer(folder, model_folder is not None), _ANSWER), "lm-answers")
    stats = answers.where("chunk IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n1", "n2")]).first()
    parts = answers.where("chunk IS NULL AND kind = 1").select(
        F.explode(F.arrays_zip(F.col("hot").alias("w"), F.col("hot_sizes").alias("n"))).alias("x"))
    found = {r["w"]: r["n"] for r in parts.groupBy("x.w").agg(F.sum("x.n").alias("n")).collect()}
    hot_sizes = np.array([found.get(w, 0) for w in hot.view(np.int64).tolist()], np.float64)
    scored = chunks.select("chunk", "ids", "held", "lengths", "tokens", "words").groupBy("chunk").cogroup(
        answers.where("chunk IS NOT NULL").select("chunk", "kind", "shard", "counts", "sizes", "codes").groupBy("chunk")
    ).applyInArrow(
        _score(shards, hot, hot_sizes, stats["n"], stats["v"], stats["n1"], stats["n2"]),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats["n"]).cast("long").alias("train_tokens"),
                         "base_score", "score")
