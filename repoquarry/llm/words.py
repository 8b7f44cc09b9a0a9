"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. All texts of a slice are
scanned together on their UTF-8 bytes, so the cost per word is a few array
operations and no Python object is made for it. Words carry 64-bit polynomial
hashes: equal words have equal hashes, and different ones collide with a chance of
about 2^-64 a pair.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_STEP = 1 << 20
_U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    """Words of one slice, in text order. ``doc`` counts rows from 0."""

    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # text i is data[bounds[i]:bounds[i + 1]]
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of slices of at most ``max_bytes``; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > max_bytes:
            yield first, i - first
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes) - first


def _release() -> None:
    """Give memory that is free back to the machine, as a worker process lives on for other tasks and stages."""
    _TABLES.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def released(run: Callable) -> Callable:
    """A function of batches that keeps no memory after its last batch."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _release()

    return whole


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their bounds; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(column: pa.Array) -> Words:
    """Words of all texts of ``column``; use ``slices`` to bound the memory."""
    data, bounds = text_bytes(column)
    inside = ~SPACE[data]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    last[before] = inside[before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1 if len(start) else np.zeros(0, np.int64)
    return Words(data, bounds, start, end, doc)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys over all bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_STEP, 1 << int(n - 1).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        for other in [k for k in _TABLES if _STEP < k != size]:
            del _TABLES[other]
    return _TABLES[size]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap.

    ``lower`` hashes A-Z as a-z. Long inputs go in steps of about a megabyte.
    """
    table, out, i = (_LOWER if lower else _BYTES), np.zeros(len(start), _U), 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + _STEP, side="right")))
        hi = end[j - 1]
        power, inverse = _tables(hi - lo)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(table[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        inverse_at = inverse[np.minimum(s, len(inverse) - 1)]
        out[i:j] = (sums[e] - sums[s]) * inverse_at + (e - s).astype(_U) * _U(0xA24BAED4963EE407)
        i = j
    return mix(out)


def word_hashes(words: Words, lower: bool = False) -> np.ndarray:
    return span_hashes(words.data, words.start, words.end, lower)


def tail_hashes(words: Words, lower: bool = False) -> np.ndarray:
    """Hashes of the last two bytes of each word, or of its only one, equal to those of spans."""
    table = _LOWER if lower else _BYTES
    two, last = words.end - words.start > 1, table[words.data[words.end - 1]]
    return mix(np.where(two, table[words.data[words.end - 2]] + last * _U(_BASE), last) + np.where(two, _U(2), _U(1)) * _U(0xA24BAED4963EE407))


def string_hashes(texts: list[str], lower: bool = False) -> np.ndarray:
    """Hashes of given words, equal to those of the same words in a text."""
    parts = [t.encode() for t in texts]
    ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    return span_hashes(data, ends - [len(p) for p in parts], ends, lower)


_ROLL = _U(0xF1357AEA2E62A9C5)


def roll(keys: np.ndarray, unit: np.ndarray, lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rolling hashes of windows of n consecutive keys inside one unit, for each n of ``lengths``.

    Yields (n, first positions, hashes). The window of n keys extends that of n - 1.
    """
    lengths, rolled = set(lengths), keys.copy()
    for n in range(1, max(lengths, default=0) + 1):
        if n > 1:
            rolled = rolled[:-1] * _ROLL + keys[n - 1 :] if len(rolled) else rolled
        if n not in lengths:
            continue
        at = np.flatnonzero(unit[: len(rolled)] == unit[n - 1 : n - 1 + len(rolled)]) if len(rolled) else np.zeros(0, np.int64)
        yield n, at, mix(rolled[at] + _U(n))


def per_unit(values: np.ndarray, unit: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` for units 0 .. n - 1, as long."""
    return np.bincount(unit, weights=values, minlength=n).astype(np.int64) if len(unit) else np.zeros(n, np.int64)
