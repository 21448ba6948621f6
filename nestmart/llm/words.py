"""Words of whole texts, vectorised over Arrow batches.

A :class:`Lexer` gives every byte a class (0 separates words) and a folded
value. UTF-8 continuation bytes are all above 0x7F, so a rule stated for code
points below 0x80 holds byte by byte. Texts are handled in pieces of about
``PIECE_BYTES``, so memory stays bounded whatever the batch holds; one text
longer than that is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_LOW = _powers(BASE, 1 << 12)
_HIGH = _powers(np.uint64(pow(int(BASE), 1 << 12, 1 << 64)), 1 << 19)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass(frozen=True)
class Lexer:
    """``kind[b]``: class of byte b, 0 for a separator; ``fold[b]``: its value in a hash."""

    kind: np.ndarray
    fold: np.ndarray

    @staticmethod
    def separated_by(separators: bytes, lower: bool = False) -> Lexer:
        kind = np.ones(256, dtype=np.uint8)
        kind[np.frombuffer(separators, dtype=np.uint8)] = 0
        fold = np.arange(256, dtype=np.uint64)
        if lower:
            fold[65:91] += np.uint64(32)
        return Lexer(kind, fold)


@dataclass
class Words:
    """Words of a piece: byte range in the piece's buffer, text number, 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


@dataclass
class Piece:
    """Consecutive texts [lo, hi) of a batch: their bytes, and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of a batch's column (NULL as the empty text) in pieces of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Piece(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def words(piece: Piece, lexer: Lexer) -> Words:
    """Maximal runs of bytes of one non-zero class inside one text."""
    n = len(piece.data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, none.astype(np.uint64))
    kind = lexer.kind[piece.data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[piece.offsets] = True
    at = np.flatnonzero(edge)
    inside = kind[at[:-1]] > 0
    start, end = at[:-1][inside], at[1:][inside]
    doc = np.searchsorted(piece.offsets, start, side="right") - 1
    return Words(start, end, doc, _hashes(piece.data, kind > 0, end - start, lexer.fold))


def _hashes(data: np.ndarray, inside: np.ndarray, lengths: np.ndarray,
            fold: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word's folded bytes modulo 2**64, finalised with its length."""
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = fold[data[inside]] + np.uint64(1)
    value *= _LOW[place & 0xFFF]
    if lengths.max() > 0x1000:
        value *= _HIGH[place >> 12]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64) * BASE)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``k`` values: sum of h[i + j] * B**j modulo 2**64.

    Runs of k are put together from runs of powers of two, so the cost is
    O(n log k). Empty when there are fewer than ``k`` values.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    run, size, done = h, 1, 0
    while True:
        if k & size:
            out += run[done:done + n] * np.uint64(pow(int(BASE), done, 1 << 64))
            done += size
        if done == k:
            return mix(out)
        run = run[:-size] + run[size:] * np.uint64(pow(int(BASE), size, 1 << 64))
        size *= 2


def spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
