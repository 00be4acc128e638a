"""Vectorised text kernels over Arrow string columns: words, hashes and counts by numpy, whole texts at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Workers live on between tasks: what Arrow frees should go back to the system.
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of text that one step works on; a longer text is a step of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15 | 1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        inverse = pow(int(_MULTIPLIER), -1, 1 << 64)
        for k, base in enumerate((int(_MULTIPLIER), inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``: differences of one running polynomial, so that length does not matter."""
    up, down = _powers(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)], out=running[1:])
    return mix64((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Chunk:
    """Some rows of a string column: their bytes, the offsets of the rows, and where their words are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.rows = data, offsets, first, len(offsets) - 1

    def spans(self, is_separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the runs of bytes that are not separators; runs never cross rows."""
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = ~is_separator
        cuts = np.unique(self.offsets)
        before = inside[:-1].copy()
        before[cuts] = False  # what stands before a row's first byte is not part of a run
        starts = np.flatnonzero(inside[1:-1] & ~before[:-1])
        after = inside[1:].copy()
        after[cuts] = False
        ends = np.flatnonzero(inside[1:-1] & ~after[1:]) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def words(self, lower: bool = False) -> Words:
        data = LOWER[self.data] if lower else self.data
        starts, ends, rows = self.spans(_SPACE[data])
        return Words(data, starts, ends, rows, self.rows)


class Words:
    """The words of a chunk: byte spans, the row of each, and the hash of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int):
        self.data, self.starts, self.ends, self.rows = data, starts, ends, rows
        self.per_row = np.bincount(rows, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.per_row)])
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def window_hashes(words: Words, size: int, whole_if_fewer: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words within a row, the row of each, and the word at which each begins.

    With ``whole_if_fewer`` a row with fewer words (but one at least) has one window of all its words.
    """
    h, n = words.hashes, len(words.hashes)
    odd = np.array([pow(0xD1342543DE82EF95, i + 1, 1 << 64) | 1 for i in range(size)], np.uint64)
    at = np.flatnonzero(words.rows[: n - size + 1] == words.rows[size - 1 :]) if n >= size else np.zeros(0, np.int64)
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        total += h[at + k] * odd[k]
    rows = words.rows[at]
    if whole_if_fewer:
        few = np.flatnonzero((words.per_row > 0) & (words.per_row < size))
        short = words.per_row[few].astype(np.uint64)
        for k in range(size - 1):
            has = words.per_row[few] > k
            short[has] += h[words.first[few[has]] + k] * odd[k]
        at, rows, total = np.concatenate([at, words.first[few]]), np.concatenate([rows, few]), np.concatenate([total, short])
    return mix64(total), rows, at


def release() -> None:
    """Gives freed memory back to the system, where the C library can: workers stay, and would keep their peak for good."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def chunks(column: pa.Array | pa.ChunkedArray, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A string column in pieces of about ``max_bytes``; nulls are empty texts. Every row comes in exactly one piece."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    first = 0
    for part in parts:
        if not len(part):
            continue
        part = part.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        body = part.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(part):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
            yield Chunk(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], first + i)
            i = j
        first += len(part)
    release()


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offset:next offset]`` for every row, empty rows included."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
