"""Elias-Fano sequences and a two-level n-gram trie over them, as flat arrays in one file."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from casewright.llm import shared_files

_BLOCK = 4096


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value in a row."""
    out = []
    for at in range(0, len(values), _BLOCK):
        raw = values[at:at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        out.append(np.packbits(np.unpackbits(raw, axis=1)[:, 64 - width:]))
    return np.concatenate(out) if out else np.empty(0, np.uint8)


def _unpack(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint64)
    bits = np.unpackbits(packed)[:n * width].reshape(n, width)
    full = np.zeros((n, 64), np.uint8)
    full[:, 64 - width:] = bits
    return np.packbits(full, axis=1).view(">u8").ravel().astype(np.uint64)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits unary, one sample per block."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, firsts: np.ndarray):
        self.n, self.width, self._low, self._high, self._samples, self._firsts = n, width, low, high, samples, firsts

    @staticmethod
    def encode(values: np.ndarray) -> tuple[np.ndarray, ...]:
        """Arrays of the sequence: (n, width), low bits, high bits, bit and value of each block's first."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length())
        places = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places.astype(np.int64)] = 1
        return (np.array([n, width], "<u8"), _pack(values, width) if width else np.empty(0, np.uint8),
                np.packbits(high), places[::_BLOCK].astype("<u8"), values[::_BLOCK].astype("<u8"))

    @classmethod
    def of(cls, arrays) -> EliasFano:
        head, low, high, samples, firsts = arrays
        return cls(int(head[0]), int(head[1]), low.view(np.uint8), high.view(np.uint8), samples, firsts)

    def block(self, b: int) -> np.ndarray:
        """Values of the ``b``-th block."""
        n = min(_BLOCK, self.n - b * _BLOCK)
        start = int(self._samples[b])
        end = int(self._samples[b + 1]) if b + 1 < len(self._samples) else len(self._high) * 8
        bits = np.unpackbits(self._high[start >> 3:(end + 7) >> 3])[start & 7:]
        ones = np.flatnonzero(bits)[:n].astype(np.uint64) + np.uint64(start - b * _BLOCK) - np.arange(n, dtype=np.uint64)
        from_byte = b * _BLOCK * self.width // 8  # blocks begin at whole bytes
        low = _unpack(self._low[from_byte:from_byte + (n * self.width + 7) // 8], n, self.width)
        return (ones << np.uint64(self.width)) | low

    def values(self) -> np.ndarray:
        blocks = [self.block(b) for b in range(len(self._samples))]
        return np.concatenate(blocks) if blocks else np.empty(0, np.uint64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of the first value not below each of the ascending ``wanted``, or -1 if it is
        another value. Every block is decoded once at most."""
        out = np.full(len(wanted), -1, np.int64)
        if not self.n or not len(wanted):
            return out
        of = np.searchsorted(self._firsts.astype(np.uint64), wanted, side="right") - 1
        blocks, begins = np.unique(of, return_index=True)
        for b, lo, hi in zip(blocks.tolist(), begins.tolist(), [*begins[1:].tolist(), len(wanted)], strict=True):
            if b >= 0:
                values, x = self.block(b), wanted[lo:hi]
                at = np.searchsorted(values, x)
                hit = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == x)
                out[lo:hi] = np.where(hit, at + b * _BLOCK, -1)
        return out


#: Bits of a successor; the rest of a key is the place of its context.
SUCCESSOR_BITS = 40
# Probabilities are quantised as log10 from -12 to 12; code 0 is "not in the trie".
_LOWEST, _STEP = -12.0, 24.0 / 65534


def quantise(log_p: np.ndarray) -> np.ndarray:
    return (np.clip(np.rint((log_p - _LOWEST) / _STEP), 0, 65533) + 1).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    """Probabilities (or counts) of codes; 0 for code 0."""
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) * _STEP + _LOWEST), 0.0)


class Trie:
    """Contexts, pointers to their successors, successors relative to their context, codes.

    A successor is stored after the place of its context, which keeps the level monotone
    and makes the search for it one within its context.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self._contexts, self._pointers, self._successors, self._codes = contexts, pointers, successors, codes

    @staticmethod
    def write(path: str, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray, codes: np.ndarray) -> None:
        """``contexts`` ascending with ``sizes`` successors each, these ascending within each."""
        place = np.repeat(np.arange(len(contexts), dtype=np.uint64), sizes)
        levels = [EliasFano.encode(x) for x in (
            contexts, np.concatenate(([0], np.cumsum(sizes))), (place << np.uint64(SUCCESSOR_BITS)) | successors)]
        arrays = [a for level in levels for a in level] + [codes.astype("<u2")]
        with shared_files.Writer(path) as out:
            out.write(np.array([a.nbytes for a in arrays], "<u8"))
            for a in arrays:
                out.write(np.concatenate([a.view(np.uint8).ravel(), np.zeros(-a.nbytes % 8, np.uint8)]))

    @classmethod
    def open(cls, path: str) -> Trie:
        data: pa.Buffer = shared_files.mapped(path)
        sizes = shared_files.array(data, "u8", 0, 16)
        arrays, at = [], 8 * len(sizes)
        for i, n in enumerate(sizes.tolist()):
            kind = "u2" if i == 15 else ("u8", "u1", "u1", "u8", "u8")[i % 5]
            arrays.append(shared_files.array(data, kind, at, n // np.dtype(kind).itemsize))
            at += -(-n // 8) * 8
        return cls(*[EliasFano.of(arrays[i:i + 5]) for i in (0, 5, 10)], arrays[15])

    def contexts(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1 if absent) and number of successors of ascending contexts."""
        at = self._contexts.find(wanted)
        bounds = self._pointers.values()
        n = np.where(at >= 0, bounds[np.maximum(at, 0) + 1] - bounds[np.maximum(at, 0)], 0) if len(bounds) > 1 else np.zeros(len(at))
        return at, n.astype(np.int64)

    def codes(self, places: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of successors of the contexts at ``places``; both ascending together."""
        keys = (places.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors
        at = self._successors.find(keys)
        return np.where(at >= 0, self._codes[np.maximum(at, 0)], 0) if len(self._codes) else np.zeros(len(at), np.uint16)
