"""Words, lines and shingles of whole Arrow text columns as numpy arrays.

All functions work inside Spark tasks, one Arrow batch at a time. A batch is cut into slices of a few MB, and a text longer
than that is read in pieces cut at separators, so memory follows the slice and the longest text's words, not the batch.

A word is a run of bytes other than space and 0x09-0x0D; hashes see A-Z as a-z unless asked otherwise. A word's hash is 64
bits wide: the sum of random per-byte values times odd powers of its place in the word, mixed at the end. Null texts are empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_RNG = np.random.default_rng(20240501)
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def give_back() -> None:
    """Returns freed memory to the system. Spark keeps workers for later tasks, and the allocators of a worker would keep the
    memory of its largest step with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def returning(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; what it has freed goes back to the system when the task ends."""
    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of a fixed odd number modulo 2**64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _STEP)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply)."""
    shifted = values >> np.uint64(33)
    v = values ^ shifted
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        v *= np.uint64(factor)
        v ^= np.right_shift(v, np.uint64(33), out=shifted)
    return v


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets within them) of consecutive slices of a string column; null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def _pieces(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        stop = min(at + limit, len(data))
        while stop < len(data):  # no word is cut
            found = np.flatnonzero(_SEPARATOR[data[stop:stop + limit]])
            if len(found):
                stop += int(found[0])
                break
            stop = min(stop + limit, len(data))
        yield at, stop
        at = stop


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True, symbols: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, hash) of every word of a slice, in order; with ``symbols`` runs of ASCII symbols are words of their own."""
    parts = [_words(data[a:b], a, offsets, fold, symbols) for a, b in _pieces(data, 4 * SLICE_BYTES)]
    if not parts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _words(data: np.ndarray, base: int, offsets: np.ndarray, fold: bool, symbols: bool):
    inside = ~_SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if symbols:
        kind = _SYMBOL[data]
        begins[1:] |= inside[1:] & (kind[1:] != kind[:-1])
    rows = offsets[(offsets >= base) & (offsets < base + len(data))] - base  # a text's first byte begins a word
    begins[rows] = inside[rows]
    start = np.flatnonzero(begins)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    run = np.add.reduceat(inside, start, dtype=np.int64)  # separators after a word add nothing
    first = np.cumsum(run) - run
    place = np.arange(int(run.sum())) - np.repeat(first, run)
    values = (_FOLDED_VALUES if fold else _BYTE_VALUES)[data[inside]] * powers(int(run.max()))[place]
    hashes = mix(np.add.reduceat(values, first) + run.astype(np.uint64) * _STEP)
    return start + base, start + run + base, np.searchsorted(offsets, start + base, "right") - 1, hashes


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of every run of ``size`` words that lies in one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(rows[:n] == rows[size - 1:])
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += hashes[at + k] * powers(size + 1)[k + 1]
    return at, mix(total)


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` texts begins in arrays that are ordered by text; one more entry for the end."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingle_sets(column: pa.Array, size: int = 5, limit: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's ``size``-word shingles; a text with fewer words is one shingle, without words none."""
    for _, data, offsets in text_slices(column, limit):
        n = len(offsets) - 1
        _, _, rows, hashes = words(data, offsets)
        at, found = windows(hashes, rows, size)
        word_at, shingle_at = row_bounds(rows, n), row_bounds(rows[at], n)
        for r in range(n):
            if shingle_at[r] < shingle_at[r + 1]:
                yield np.unique(found[shingle_at[r]:shingle_at[r + 1]])
            else:
                own = hashes[word_at[r]:word_at[r + 1]]
                yield mix((own * powers(size + 1)[1:len(own) + 1]).sum(keepdims=True)) if len(own) else np.zeros(0, np.uint64)


def digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for an ordered array of hashes."""
    if not len(values):
        return 0, 0
    a = mix(values + np.uint64(0x51ED270B)).sum(dtype=np.uint64)
    b = mix(values ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(a.astype(np.int64)), int(b.astype(np.int64))
