"""Words of whole texts and their 64-bit hashes, computed on Arrow string buffers.

A word is ``[^\\x20\\x09-\\x0D]+``. Separators are single ASCII bytes, so words can be
cut on UTF-8 bytes. Memory follows a block of about one megabyte, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of a batch: hashes, byte spans in ``data``, first word of each row."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def count(self, i: int) -> int:
        return int(self.first[i + 1] - self.first[i])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(raw[2], dtype=np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    return data, offsets - low


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """All words of a string column; ``lower`` folds A-Z before hashing."""
    data, offsets = text_buffers(column)
    inside = ~_SEP[data]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    edge[cut] = inside[cut]
    starts = np.flatnonzero(edge)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    back = cut[cut > 0] - 1
    last[back] = inside[back]
    ends = np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        part = data[a:b]
        part = (_LOWER[part] if lower else part).astype(np.uint64)
        part[~inside[a:b]] = 0
        begin = starts[i:j] - a
        length = ends[i:j] - starts[i:j]
        step = np.diff(np.append(begin, b - a))
        place = np.arange(b - a) - np.repeat(begin, step)
        part *= _powers(int(step.max()))[place]
        sums = np.add.reduceat(part, begin)
        hashes[i:j] = mix(sums + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return Words(data, hashes, starts, ends, np.searchsorted(starts, offsets, side="left"))


def window_hash(h: np.ndarray, size: int, at: np.ndarray | None = None, seed: int = 0x1B873593) -> np.ndarray:
    """Hashes of the windows of ``size`` consecutive words that start at ``at`` (all, if none)."""
    if at is None:
        at = np.arange(max(0, len(h) - size + 1))
    out = np.zeros(len(at), dtype=np.uint64)
    factor = np.uint64(1)
    step = np.uint64((seed << 33 | 0xA0761D6478BD642F) & 0xFFFFFFFFFFFFFFFF | 1)
    with np.errstate(over="ignore"):
        for k in range(size):
            out += h[at + k] * factor
            factor = factor * step
    return mix(out)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows with about ``most`` bytes of text (one row at least)."""
    at = batch.schema.get_field_index(column)
    sizes = _lengths(batch.column(at))
    total = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        before = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(i, j - i)
        i = j


def _lengths(column: pa.Array) -> np.ndarray:
    _, offsets = text_buffers(column)
    return np.diff(offsets)
