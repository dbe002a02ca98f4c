"""Vectorised kernels over Arrow string columns: words, word hashes, window hashes.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  Every kernel works on whole texts; long ones are
taken in slices that end between words, so the arrays built are a small multiple of the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 5)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; many times faster than numpy's hash-based unique on 64-bit hashes."""
    out = np.sort(values)
    keep = np.ones(len(out), dtype=bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def _table() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, 257, dtype=_U)) * _U(0xD6E8FEB86659FD93))


BYTE = _table()
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]

_pow: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _pow.get("up")
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for key, step in (("up", _BASE), ("down", inverse)):
                full = np.full(size, step, dtype=_U)
                full[0] = 1
                _pow[key] = np.cumprod(full, dtype=_U)
    return _pow["up"], _pow["down"]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[starts[i]:ends[i]]`` for each i, independent of the place, finalised."""
    if len(starts) == 0:
        return np.zeros(0, dtype=_U)
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * up[: len(values)], dtype=_U, out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        return mix(h ^ ((ends - starts).astype(_U) * _U(0xA0761D6478BD642F)))


@dataclass
class Words:
    """Words of a block of rows: byte spans, hashes, and ``ptr`` with the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    ptr: np.ndarray


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def _slice_words(raw: np.ndarray, cuts: np.ndarray, table: np.ndarray, want_hash: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans and hashes of the words of ``raw``; ``cuts`` are offsets no word may cross."""
    solid = ~SPACE[raw]
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    before[0] = False
    inner = cuts[cuts < len(raw)]
    before[inner] = False
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    after[-1] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    hashes = run_hashes(table[raw], starts, ends) if want_hash else np.zeros(0, dtype=_U)
    return starts, ends, hashes


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, want_hash: bool = True) -> Words:
    """Words of the rows ``raw[offsets[i]:offsets[i+1]]``."""
    table = BYTE_LOWER if lower else BYTE
    if len(raw) <= 2 * SLICE:
        if len(raw) == 0:
            empty = np.zeros(0, dtype=np.int64)
            return Words(empty, empty, np.zeros(0, dtype=_U), np.zeros(len(offsets), dtype=np.int64))
        starts, ends, hashes = _slice_words(raw, offsets, table, want_hash)
    else:
        parts, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + SLICE)
            while end < len(raw) and not SPACE[raw[end]]:
                gap = np.flatnonzero(SPACE[raw[end : end + SLICE]])
                end = end + int(gap[0]) if len(gap) else min(len(raw), end + SLICE)
            inside = offsets[(offsets >= at) & (offsets < end)] - at
            s, e, h = _slice_words(raw[at:end], inside, table, want_hash)
            parts.append((s + at, e + at, h))
            at = end
        starts, ends, hashes = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def give_back() -> None:
    """Return the memory that was freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and what it freed goes back to the system at its end: Spark keeps the worker, and it shall wait small."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return go


def word_blocks(column: pa.Array, lower: bool = False, limit: int = SLICE, want_hash: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Words]]:
    """(first row, last row, bytes, offsets, words) for blocks of rows."""
    raw, offsets = string_buffer(column)
    for lo, hi in row_blocks(offsets, limit):
        part, own = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        yield lo, hi, part, own, words_of(part, own, lower, want_hash)


def window_hashes(values: np.ndarray, ptr: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``size`` consecutive values that stay inside one row."""
    n = len(values)
    if n < size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    ends_of_row = np.repeat(ptr[1:], np.diff(ptr))
    starts = np.arange(n, dtype=np.int64)
    starts = starts[starts + size <= ends_of_row]
    return starts, run_hashes(values, starts, starts + size)
