"""Words of Arrow text columns as NumPy arrays, without a Python object per word.

Used inside tasks only; Spark decides which rows a task gets. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text handled at once; a longer single text is handled alone
SPACES = (0x20, *range(0x09, 0x0E))

_U = np.uint64

# The workers of an executor share its memory with the JVM. The system's allocator gives large buffers back when they are freed; Arrow's own
# pools would keep them for the worker's whole life.
pa.set_memory_pool(pa.system_memory_pool())


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_CHUNKS_PER_TRIM = 16


def give_back() -> None:
    """Returns freed memory to the system. Buffers of changing sizes leave holes, and a worker lives as long as its executor."""
    if _trim is not None:
        _trim(0)


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


_BASE = _U(0x5851F42D4C957F2D)  # any odd number
_BACK = _U(pow(0x5851F42D4C957F2D, -1, 2**64))
_BYTE = _random_words(256, 1)
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z as a-z

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        _powers[:] = [np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, _BACK)]
    return _powers[0], _powers[1]


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each, at least one row; null texts become empty."""
    text, index = batch.column(column), batch.schema.get_field_index(column)
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offsets = np.frombuffer(text.buffers()[1], width)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, width)
    first, n = 0, 0
    while first < len(text):
        n += 1
        if n % _CHUNKS_PER_TRIM == 0:
            give_back()
        last = max(first + 1, int(np.searchsorted(offsets, int(offsets[first]) + limit, side="right")) - 1)
        part = batch.slice(first, last - first)
        yield part.set_column(index, column, part.column(column).cast(pa.large_string()).fill_null(""))  # copies no more than this part
        first = last
    give_back()


class Words:
    """The words of a text array: ``starts`` and ``ends`` in ``data``, and ``rows``, the row of each word."""

    def __init__(self, text: pa.Array, separators: tuple[int, ...] = SPACES):
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        raw = text.buffers()[2]
        self.data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.n_rows = len(text)
        gap = np.zeros(256, bool)
        gap[list(separators)] = True
        inside = ~gap[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(inside):
            before[0], before[1:] = True, ~inside[:-1] | edge[1:-1]
            after[-1], after[:-1] = True, ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.rows = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.rows, minlength=self.n_rows)
        self.first = np.r_[0, np.cumsum(self.counts)]
        self._sums: tuple[bool, np.ndarray] | None = None

    def hashes(self, fold: bool = True, prefix: int | None = None) -> np.ndarray:
        """One 64-bit hash per word, by default of the word with A-Z lower-cased; with ``prefix`` of its first bytes."""
        power, back = _power_tables(len(self.data))
        if self._sums is None or self._sums[0] != fold:
            sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((_FOLDED if fold else _BYTE)[self.data] * power[:len(self.data)], out=sums[1:])
            self._sums = fold, sums
        sums = self._sums[1]
        ends = self.ends if prefix is None else np.minimum(self.ends, self.starts + prefix)
        return mix((sums[ends] - sums[self.starts]) * back[self.starts] + (ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _U(0xD6E8FEB86659FD93) + words[k:k + n]
    return mix(total)
