"""Alignment of two tokenizers: groups of tokens between shared cuts, and counts of linked ids.

Both tokenizers split the same bytes. Offsets at which a token of each ends are shared
cuts; they are found by divide and conquer, and the tokens between neighbouring cuts are a
group. Tokens whose byte ranges overlap are linked; a pair of ids counts the documents
that link it anywhere in the corpus.
"""

from __future__ import annotations

import functools
import io
import itertools
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from casewright.llm import shared_files
from casewright.llm.common import written
from casewright.session import run_folder

#: A space between printable ASCII characters. Both tokenizers begin a token there.
_BREAK = re.compile(r"(?<=[!-~]) (?=[!-~])")


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token counts (of A, of B) up to each shared cut, in order.

    ``parts`` are known shared cuts as rows (tokens of A, tokens of B), the last one the
    end. Every interval between known cuts is taken apart: from the token of A that ends
    next to its middle, bisecting the ends of B and of A in turn leads to the nearest common
    end above it, or else below it. Both halves are taken apart again; an interval
    without a common end inside is a group. All intervals of one depth go together.
    """
    ends = np.asarray(parts, np.int64).reshape(-1, 2)
    open_ = np.column_stack([np.vstack([[0, 0], ends])[:-1], ends])  # from A, from B, to A, to B
    done = []
    while len(open_):
        one = (open_[:, 2] - open_[:, 0] < 2) | (open_[:, 3] - open_[:, 1] < 2)
        done.append(open_[one, 2:])
        open_ = open_[~one]
        middle = (open_[:, 0] + open_[:, 2] - 2) // 2
        i, j, found = middle.copy(), np.zeros(len(open_), np.int64), np.zeros(len(open_), bool)
        for up in (True, False):
            on = np.flatnonzero(~found)
            i[on] = middle[on]
            while len(on):
                if up:
                    j[on] = np.searchsorted(b_ends, a_ends[i[on]])
                    on = on[j[on] < open_[on, 3] - 1]
                else:
                    j[on] = np.searchsorted(b_ends, a_ends[i[on]], "right") - 1
                    on = on[j[on] >= open_[on, 1]]
                met = a_ends[i[on]] == b_ends[j[on]]
                found[on[met]] = True
                on = on[~met]
                if up:
                    i[on] = np.searchsorted(a_ends, b_ends[j[on]])
                    on = on[i[on] < open_[on, 2] - 1]
                else:
                    i[on] = np.searchsorted(a_ends, b_ends[j[on]], "right") - 1
                    on = on[i[on] >= open_[on, 0]]
        done.append(open_[~found, 2:])
        cut = np.column_stack([i[found] + 1, j[found] + 1])
        open_ = np.vstack([np.hstack([open_[found, :2], cut]), np.hstack([cut, open_[found, 2:]])])
    cuts = np.vstack(done) if done else np.zeros((0, 2), np.int64)
    cuts = cuts[np.argsort(cuts[:, 0], kind="stable")]
    return cuts[:, 0], cuts[:, 1]


class TokenizerPair:
    """Aligned pieces of text, remembered.

    Where both tokenizers always begin a token at a space between printable ASCII
    characters (a byte-level splitter for A; no piece of B with a space inside), a text is
    cut there and each distinct piece is encoded and aligned once; otherwise the text is
    one piece. A piece has A's ids for space + piece, B's ids for the piece, groups, links.
    """

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        path = public_tokenizers.path(a_file)
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file))
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.n_b = len(names)
        splitter = how.get("pre_tokenizer") or {}
        self.cuts = (
            how.get("normalizer") is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space") and self.b.encode("a", out_type=str)[0].startswith("▁")
            and all("▁" not in n.lstrip("▁") for n in names))
        shown = [str(i) for i in range(max(len(self.a_bytes), self.n_b))]
        self._shown = np.array([[(i + mark).encode() for i in shown] for mark in (",", "|", ";", "")], object)
        self._widths = np.array([len(i) for i in shown], np.int64)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.bytes = 0
        self._text, self._links = [], []  # pools that the ends below refer to
        self.valid = np.zeros(0, bool)
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.link_ends = np.zeros(1, np.int64)
        self.text_ends = np.zeros(1, np.int64)

    def links(self) -> np.ndarray:
        """Link keys of all pieces, split by ``link_ends``."""
        return np.concatenate([np.zeros(0, np.int64), *self._links])

    def text(self) -> bytes:
        """Groups of all pieces, split by ``text_ends``."""
        return b"".join(self._text)

    def pieces(self, text: str) -> list[str]:
        return _BREAK.split(text) if self.cuts else [text]

    def learn(self, texts: set[str]) -> None:
        """Encode and align pieces not yet known."""
        new = [t for t in texts if t not in self.number]
        # Where a token begins at a space after printable ASCII, pieces that end so go together.
        plain = [t for t in new if self.cuts and t and "!" <= t[0] <= "~" and "!" <= t[-1] <= "~" and "▁" not in t]
        self._learn(plain, together=True)
        self._learn([t for t in new if t not in self.number], together=False)

    def _learn(self, new: list[str], together: bool) -> bool:
        """Whether all could be learned; always true one by one."""
        if not new:
            return True
        spaced = [b" " + t.encode() for t in new]
        n = np.fromiter(map(len, spaced), np.int64, len(new))
        ends, whole, ok = np.cumsum(n), b"".join(spaced), np.ones(len(new), bool)
        if together:
            joined = [" ".join(new[i:i + 100]) for i in range(0, len(new), 100)]
            a_ids = [e.ids for e in self.a.encode_batch_fast([" " + t for t in joined], add_special_tokens=False)]
            a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (a_ids, self.b.encode(joined, num_threads=1)))
            counts = []
            for ids, table, sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
                if b"".join([table[i] for i in ids.tolist()]) != whole:
                    return False
                at = np.cumsum(sizes[ids])
                to = np.searchsorted(at, ends)
                if (at[to] != ends).any():
                    return False
                counts.append(np.diff(to + 1, prepend=0))
            n_a, n_b = counts
        else:
            a_ids = [e.ids for e in self.a.encode_batch_fast([" " + t for t in new], add_special_tokens=False)]
            b_ids = self.b.encode(new, num_threads=1)
            n_a, n_b = (np.fromiter(map(len, x), np.int64, len(new)) for x in (a_ids, b_ids))
            a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (a_ids, b_ids))
            for ids, table in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)):
                ok &= [b"".join([table[i] for i in x]) == w for x, w in zip(ids, spaced, strict=True)]
            a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
            n_a, n_b = n_a * ok, n_b * ok
        text, text_sizes, links, link_sizes, n_groups = self._aligned(a, b, n_a, n_b, ok)
        self.number.update(zip(new, range(len(self.valid), len(self.valid) + len(new)), strict=True))
        self.valid = np.concatenate([self.valid, ok])
        self.sizes = np.vstack([self.sizes, np.column_stack([n_a, n_b, n_groups])])
        self.link_ends = np.concatenate([self.link_ends, self.link_ends[-1] + np.cumsum(link_sizes)])
        self.text_ends = np.concatenate([self.text_ends, self.text_ends[-1] + np.cumsum(text_sizes)])
        self._text.append(text)
        self._links.append(links)
        self.bytes += 250 * len(new) + len(whole) + len(text) + 8 * len(links)
        return True

    def _aligned(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, ok: np.ndarray):
        """Groups as text, link keys and numbers of groups; sizes are by piece."""
        none = np.zeros(len(ok), np.int64)
        if not len(a):
            return b"", none, none, none, none
        parts = np.column_stack([np.cumsum(n_a[ok]), np.cumsum(n_b[ok])])
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_cuts, b_cuts = shared_cuts(a_ends, b_ends, parts)
        # Between neighbouring ends of either side just one token of each overlaps.
        ends = _distinct(np.concatenate([a_ends, b_ends]))
        keys = a[np.searchsorted(a_ends, ends)] * self.n_b + b[np.searchsorted(b_ends, ends)]
        # Ids in the order of the text form: A's of a group, then B's, each with what follows it.
        group_a, group_b = np.searchsorted(a_cuts, np.arange(len(a)), "right"), np.searchsorted(b_cuts, np.arange(len(b)), "right")
        place_a = np.arange(len(a)) + np.concatenate(([0], b_cuts))[group_a]
        place_b = np.arange(len(b)) + a_cuts[group_b]
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = a, b
        marks = np.zeros(len(order), np.int64)
        marks[place_a[a_cuts - 1]], marks[place_b[b_cuts - 1]] = 1, 2
        last = parts.sum(axis=1) - 1
        marks[last] = 3
        shown = self._shown[marks, order]
        lengths = np.concatenate(([0], np.cumsum(self._widths[order] + (marks < 3))))
        counts = np.zeros((len(ok), 3), np.int64)
        counts[ok] = np.column_stack([
            np.diff(lengths[last + 1], prepend=0), np.diff(np.searchsorted(ends, a_ends[parts[:, 0] - 1]) + 1, prepend=0),
            np.diff(np.searchsorted(a_cuts, parts[:, 0]) + 1, prepend=0)])
        return b"".join(shown.tolist()), counts[:, 0], keys, counts[:, 1], counts[:, 2]


def _byte_letters() -> dict[str, int]:
    """Byte of each printable stand-in: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=1)
def tokenizer_pair(a_file: str, b_file: str) -> TokenizerPair:
    return TokenizerPair(a_file, b_file)


def _flat(parts: list[np.ndarray], kind=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """Arrays end to end, and where each begins and the last one ends."""
    return np.concatenate([np.zeros(0, kind), *parts]), np.cumsum([0, *map(len, parts)])


def _of(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of ranges that begin at ``starts`` and have ``lengths``, end to end."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    whole = np.concatenate(([0], np.cumsum(values)))
    return whole[bounds[1:]] - whole[bounds[:-1]]


def _save(path: str, **arrays: np.ndarray) -> None:
    out = io.BytesIO()
    np.savez(out, **arrays)
    with shared_files.Writer(path) as f:
        f.write(zstandard.ZstdCompressor(level=3).compress(out.getvalue()))


def _load(path: str) -> dict[str, np.ndarray]:
    held = zstandard.ZstdDecompressor().decompress(shared_files.mapped(path).to_pybytes())
    return dict(np.load(io.BytesIO(held)))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _chunk(pair: TokenizerPair, docs: list[np.ndarray], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Write a chunk, documents as numbers of pieces; its distinct link keys and their documents."""
    numbers, bounds = _flat(docs)
    counts = np.bincount(numbers, minlength=len(pair.valid))
    used = np.flatnonzero(counts)
    used = used[np.argsort(-counts[used], kind="stable")]  # frequent pieces get small numbers
    renamed = np.zeros(len(counts), np.int64)
    renamed[used] = np.arange(len(used))
    numbers = renamed[numbers]
    lengths = np.diff(pair.link_ends)[used]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    keys, refs = np.unique(pair.links()[_of(lengths, pair.link_ends[used])], return_inverse=True)
    # Documents of each key: distinct (document, piece), then distinct (document, key).
    doc = np.repeat(np.arange(len(docs)), np.diff(bounds))
    in_doc = _distinct(doc * max(1, len(used)) + numbers)
    doc, piece = in_doc // max(1, len(used)), in_doc % max(1, len(used))
    pairs = _distinct(np.repeat(doc, lengths[piece]) * max(1, len(keys)) + refs[_of(lengths[piece], ends[piece])])
    n = np.bincount(pairs % max(1, len(keys)), minlength=len(keys))
    text_sizes = np.diff(pair.text_ends)[used]
    text = np.frombuffer(pair.text(), np.uint8)[_of(text_sizes, pair.text_ends[used])]
    _save(path, numbers=numbers.astype(np.uint32), bounds=bounds, refs=refs.astype(np.uint32), ends=ends.astype(np.uint32),
          sizes=pair.sizes[used].astype(np.uint32), text=text, text_ends=np.concatenate(([0], np.cumsum(text_sizes))))
    return keys, n


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values, kind="stable")
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


_ROW = "chunk long, path string, keys binary, documents binary, "


def _gather(docs: DataFrame, id_col: str, text_col: str, files: tuple[str, str], chunk_links: int, slice_chars: int,
            remembered: int) -> DataFrame:
    folder = run_folder(docs.sparkSession, "aligned")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*files)
        pair.clear()
        ids, held, links, k = [], [], 0, TaskContext.get().partitionId() << 24

        def done() -> pa.RecordBatch:
            path = f"{folder}/chunk-{uuid.uuid4().hex}"
            keys, n = _chunk(pair, held, path)
            return pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([path]), pa.array([_packed(np.diff(keys, prepend=0))], pa.binary()),
                 pa.array([_packed(n.astype(np.uint32))], pa.binary()), pa.array([ids], pa.list_(arrow_kind))],
                names=["chunk", "path", "keys", "documents", "doc_ids"])

        for names, texts in _slices(batches, slice_chars):
            cut = [pair.pieces(t) if t else [] for t in texts]
            pair.learn({p for pieces in cut for p in pieces})
            for name, pieces in zip(names, cut, strict=True):
                own = np.fromiter(map(pair.number.__getitem__, pieces), np.int64, len(pieces))
                if not pair.valid[own].all():
                    own = own[:0]
                ids.append(name)
                held.append(own)
                links += int((pair.link_ends[own + 1] - pair.link_ends[own]).sum())
                if links >= chunk_links:
                    yield done()
                    ids, held, links, k = [], [], 0, k + 1
            if pair.bytes > remembered:  # bounds memory; only costs encoding again
                if ids:
                    yield done()
                    ids, held, links, k = [], [], 0, k + 1
                pair.clear()
        if ids:
            yield done()
        pair.clear()  # workers are used again

    return written(rows.mapInArrow(run, _ROW + f"doc_ids array<{kind.simpleString()}>"), "aligned-chunks")


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[str]]]:
    """Identifiers and texts of about ``most`` characters at a time."""
    for batch in batches:
        names, texts, size = [], [], 0
        for name, text in zip(batch.column(0), batch.column(1), strict=True):
            names.append(name.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= most:
                yield names, texts
                names, texts, size = [], [], 0
        if names:
            yield names, texts


def _asked(chunks: DataFrame) -> DataFrame:
    """``chunk, at, key, n``: the distinct link keys of each chunk and their documents there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            keys, n = np.cumsum(_unpacked(row["keys"], np.int64)), _unpacked(row["documents"], np.uint32).astype(np.int64)
            for a in range(0, len(keys), 1 << 16):
                own = slice(a, a + (1 << 16))
                size = len(keys[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, row["chunk"])), pa.array(np.arange(a, a + size, dtype=np.int32)),
                     pa.array(keys[own]), pa.array(n[own])], names=["chunk", "at", "key", "n"])

    return chunks.select("chunk", "keys", "documents").mapInArrow(run, "chunk long, at int, key long, n long")


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _judged(arrow_kind: pa.DataType):
    """Documents of a chunk from its file and the counts of its link keys."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        held = _load(row["path"])
        told = np.zeros(answers.num_rows, np.int64)
        told[answers["at"].to_numpy()] = answers["told"].to_numpy()
        told = told[held["refs"]] if len(told) else told
        numbers, bounds, ends = held["numbers"], held["bounds"], held["ends"].astype(np.int64)
        sizes = held["sizes"].astype(np.int64)
        of_piece = np.column_stack([sizes, np.diff(ends), _sums(told & 1, ends), _sums(told >> 1, ends)])[numbers]
        out = {name: pa.array(_sums(of_piece[:, c], bounds)) for c, name in enumerate(_COUNTS)}
        text, to = held["text"].tobytes(), held["text_ends"].tolist()
        parts = [text[a:b] for a, b in zip(to[:-1], to[1:], strict=True)]
        edge = bounds.tolist()
        numbers = numbers.tolist()
        groups = [b";".join(map(parts.__getitem__, numbers[a:b])) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table({"doc_id": pa.array(row["doc_ids"], arrow_kind)} | out | {"groups": pa.array(groups, pa.binary()).cast(pa.string())})
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = "byte_bpe_50k.json",
          b_file: str = "piece_bpe_32k.model", chunk_links: int = 2_000_000, slice_chars: int = 1 << 20,
          remembered: int = 100 << 20) -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A (a file of the tokenizers library, byte-level) encodes a space and the text, B (a
    sentencepiece model, which adds the space itself) the text, both without special
    tokens. ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids between shared cuts. Every overlap of
    a token of A with one of B is a link; its count is the number of documents that link
    that pair of ids. ``n_best`` are links whose count is the highest of their id of A, ``count_sum``
    adds up counts. Null and empty texts, and those whose tokens do not give back the bytes
    of space and text, have no tokens: zeros and an empty text.

    Tasks gather chunks of about ``chunk_links`` links (a longer text is a chunk of its own) and
    keep them as files in the shared folder. Only the distinct pairs of each chunk are
    shuffled: to be counted, and with their counts back to the chunk, which then reads its
    file. A task remembers pieces of text up to about ``remembered`` bytes. Identifiers may
    be null or repeated; an empty table gives no rows; other columns are ignored.
    """
    chunks = _gather(docs, id_col, text_col, (a_file, b_file), chunk_links, slice_chars, remembered)
    asked = _asked(chunks)
    n_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file)).get_piece_size()
    counts = written(asked.groupBy("key").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"key div {n_b}")), "aligned-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    told = (2 * F.col("n") + (F.col("n") == F.col("most")).cast("long")).alias("told")
    judged = counts.join(best, "a").select("key", told)
    answers = asked.select("chunk", "at", "key").join(judged, "key").select("chunk", "at", "told")
    kind = docs.schema[id_col].dataType
    return chunks.select("chunk", "path", "doc_ids").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _judged(to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", groups string")
