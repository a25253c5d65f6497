"""Words and word hashes of Arrow text columns, computed with numpy over the raw UTF-8 bytes.

Every function works on one slice of a batch (see :func:`pieces`), so memory stays bounded
however long a batch or a table is. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

#: Bytes that belong to a word of the pattern [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes that belong to a word of the pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about ``limit`` bytes of text (a longer row stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row bounds) of a string column; nulls become empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; works in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Words of some texts: byte bounds ``start``/``end``, ``first[i]`` the first word of row i."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        self.data, self.bounds = data, bounds
        inside = table[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[edge[:-1]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self.inside = inside

    @property
    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        at = np.flatnonzero(self.inside)
        place = at - np.repeat(self.start, length)
        powers = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
        value = _BYTE[self.data[at]]
        value *= powers[place]
        total = np.add.reduceat(value, np.cumsum(length) - length)
        return mix(total + length.astype(np.uint64) * _STEP[0])


def windows(words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive words (rows are not told apart); length len(words)-n+1."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    step, size, level, out, done = _STEP[lane], 1, words, None, 0
    while size <= n:
        if n & size:
            tail = level[done:] if done else level
            if out is None:
                out = tail
            else:
                k = min(len(out), len(tail))
                out = mix(out[:k] * step + tail[:k] + np.uint64(size))
            done += size
        size *= 2
        if size <= n:
            half = size // 2
            level = mix(level[:-half] * step + level[half:])
    return mix(out[: len(words) - n + 1] + np.uint64(n * int(_STEP[1 - lane]) % 2**64))


def whole(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """For each window start 0..total-n: does the window stay in its row?"""
    count = np.diff(first)
    row_end = np.repeat(first[1:], count)[: max(0, total - n + 1)]
    return np.arange(len(row_end)) + n <= row_end
