"""Token output: flat files of unsigned token ids with 64-bit document offsets.

A set of files has one triple per range of identifiers: ``.ids`` (token ids, 16 bits where
the vocabulary allows it, else 32), ``.offsets`` (64-bit start of each document in the file,
and the end) and ``.docs`` (64-bit identifiers). A manifest, one row per triple, carries the
bases, prefix sums of tokens and documents. All integers are little-endian.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from casewright.llm import shared_files
from casewright.llm.common import trimmed, written
from casewright.session import run_folder

#: What the fast path below takes apart by itself.
_LOWERED = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Chunks whose splitting and lower-casing need no library: ASCII and Latin-1 letters without
#: ``<|``, and how they split.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÿ]+")
_PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_MANIFEST = "part int, stem string, kind string, n_docs long, n_tokens long, null_docs long"


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Token ids (as bytes) of chunks between ASCII white space, remembered.

    Where a file normalises and splits as fixed above, no token spans white space, so a
    text's ids are those of its chunks in a row. Plain chunks are split here and their pieces
    go to the library's BPE model once each; any other chunk goes through the whole library
    encoder. With any other file, whole texts do. About ``most`` bytes are remembered.
    """

    def __init__(self, file: str, most: int = 32 << 20):
        super().__init__()
        path = public_tokenizers.path(file)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        self.by_chunk = how.get("normalizer") == _LOWERED and how.get("pre_tokenizer") == _SPLIT
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._model, self._most = self.tokenizer.model, most
        self._code = "H" if self.kind.itemsize == 2 else "I"
        self._letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self._pieces: dict[str, bytes] = {}
        self._bytes = 0

    def forget(self) -> None:
        self.clear()
        self._pieces.clear()
        self._bytes = 0

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _piece(self, piece: str) -> bytes:
        if (ids := self._pieces.get(piece)) is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._letters)
            ids = self._pieces[piece] = self._ids([t.id for t in self._model.tokenize(shown)])
            self._bytes += 200 + 4 * len(piece) + len(ids)
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters are one piece
            out = self._piece(chunk.decode().lower())
        else:
            text = chunk.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text) and "<|" not in text:
                out = b"".join(map(self._piece, _PLAIN_PIECES.findall(text.lower())))
            else:
                out = self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self._bytes > self._most:  # bounds memory; only costs encoding again
            self.forget()
        if len(chunk) < 256:
            self[chunk] = out
            self._bytes += 200 + len(chunk) + len(out)
        return out

    def encode(self, text: bytes) -> bytes:
        if not self.by_chunk:
            return self._ids(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=1)
def encoder(file: str, most: int = 32 << 20) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordEncoder(file, most)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", cache_bytes: int = 224 << 20) -> DataFrame:
    """Encode whole texts and write them in ascending ``id_col`` order below ``folder``.

    A worker remembers the ids of about ``cache_bytes`` of chunks, also for its next tasks; fewer
    only cost encoding again.

    Returns the manifest (a Parquet table in ``folder``): ``part, stem, kind, n_docs,
    n_tokens, null_docs, token_base, doc_base``. Rows are dealt out by ranges of the
    identifier, then of a text hash, so that even one identifier with very many texts is
    spread. Every attempt of a task writes files of its own name and only those of the
    attempts that finished are in the manifest. Null texts are empty (only the end token);
    null identifiers come first; repeated ones stay apart, by text hash. An empty table
    gives an empty manifest.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(tokenizer, cache_bytes), TaskContext.get().partitionId()
        end = np.array([end_id], words.kind).tobytes()
        stem = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        at, docs_n, nulls = 0, 0, 0
        with (shared_files.Writer(f"{stem}.ids") as ids, shared_files.Writer(f"{stem}.offsets") as offsets,
              shared_files.Writer(f"{stem}.docs") as names):
            for batch in batches:
                out, starts = [], []
                for text in batch.column("text"):
                    starts.append(at)
                    out.append(words.encode(text.as_py()) + end)
                    at += len(out[-1]) // words.kind.itemsize
                ids.write(b"".join(out))
                offsets.write(np.array(starts, "<u8"))
                nulls += batch.column("doc_id").null_count
                names.write(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                docs_n += batch.num_rows
            offsets.write(np.array([at], "<u8"))
        if docs_n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([stem]), pa.array([words.kind.str]), pa.array([docs_n]),
                 pa.array([at]), pa.array([nulls])],
                names=["part", "stem", "kind", "n_docs", "n_tokens", "null_docs"])

    done = written(parts.mapInArrow(trimmed(write), _MANIFEST), "token-parts")
    # One row per file: as many as there are partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    done.select(
        "*", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base)
               for n, base in (("n_tokens", "token_base"), ("n_docs", "doc_base"))],
    ).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame, slice_docs: int = 20_000) -> DataFrame:
    """Documents of the files: ``doc_id, start, n_tokens, ids_crc32``.

    Slices of ``slice_docs`` documents are mapped and read apart. ``start`` is the place of
    the first id among all ids; the checksum is over the ids as 32-bit integers.
    """
    slices = manifest.withColumn(
        "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(slice_docs).cast("long"))))
    n = manifest.sparkSession.sparkContext.defaultParallelism * 4
    dealt = slices.repartition(n, "part", "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            a, b = row["first"], min(row["first"] + slice_docs, row["n_docs"])
            offsets = shared_files.array(shared_files.mapped(f"{row['stem']}.offsets"), "u8", 8 * a, b - a + 1)
            names = shared_files.array(shared_files.mapped(f"{row['stem']}.docs"), "i8", 8 * a, b - a)
            ids = shared_files.array(shared_files.mapped(f"{row['stem']}.ids"), row["kind"])
            sums = [zlib.crc32(ids[x:y].astype("<u4").tobytes())
                    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            known = np.arange(a, b) >= row["null_docs"]  # null identifiers come first
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, mask=~known), pa.array(offsets[:-1].astype("i8") + row["token_base"]),
                 pa.array(np.diff(offsets.astype("i8"))), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, **how) -> DataFrame:
    """Write the token files to a new shared folder and read them back."""
    return read_tokens(write_tokens(docs, run_folder(docs.sparkSession, "tokens"), **how))
