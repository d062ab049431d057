"""Texts by reference: written once inside tasks, read back by place.

Operators that come back to few texts, or to all of them in order, move references of a
few bytes instead of texts. A file holds the texts of one task attempt, each compressed
on its own; only files of attempts that finished are ever referred to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from casewright.llm import shared_files
from casewright.llm.common import trimmed

#: Columns of a reference.
PLACE = "stored string, stored_at long, stored_bytes int"


class TextWriter(shared_files.Writer):
    """Adds texts to a file of its own below ``folder``; usable in a ``with`` block."""

    def __init__(self, folder: str):
        self.path = f"{folder}/texts-{uuid.uuid4().hex}"
        super().__init__(self.path)
        self._at, self._press = 0, zstandard.ZstdCompressor(level=3)

    def add(self, texts: list[bytes]) -> list[tuple[str, int, int]]:
        """The place of each text."""
        packed = [self._press.compress(t) for t in texts]
        self.write(b"".join(packed))
        places = []
        for p in packed:
            places.append((self.path, self._at, len(p)))
            self._at += len(p)
        return places


def fetch(path: str, at: int, length: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(shared_files.pieces(path).get(at, length))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with the columns of ``PLACE`` so that each file is read by one task, front to back."""
    return rows.repartition("stored").sortWithinPartitions("stored", "stored_at")


def with_texts(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with ``text_col`` in place of the columns of ``PLACE``; a null place is a null text."""
    places = [c.split()[0] for c in PLACE.split(", ")]
    kept = [c for c in rows.columns if c not in places]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [None if at[0] is None else fetch(*at)
                         for at in zip(*[part.column(c).to_pylist() for c in places], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, text_col])
        shared_files.pieces.cache_clear()  # workers are used again

    types = dict(rows.dtypes)
    return in_order(rows).mapInArrow(trimmed(run), ", ".join(f"`{c}` {types[c]}" for c in kept) + f", `{text_col}` string")
