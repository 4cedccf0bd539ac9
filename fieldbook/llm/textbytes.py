"""Vectorised text primitives over Arrow string buffers: words, lines, shingles and their 64-bit hashes.

Everything works on whole byte buffers at once; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text handled at a time; one longer document is handled alone
CHUNK_BYTES = 1 << 18
#: longest tables of powers that a worker keeps
KEPT_POWERS = 4 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = text_buffer(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + (64 << 10))
        up = np.full(size, _BASES[which], dtype=np.uint64)
        down = np.full(size, pow(_BASES[which], -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= KEPT_POWERS:
            _powers[which] = have
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal for equal bytes wherever they stand."""
    up, down = _tables(len(data) + 1, which)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def words(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that are no separators."""
    inside = ~separator[data]
    edges = offs[offs < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    before[edges] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word of A-Z lower-cased text."""
    low = LOWER[data]
    starts, ends, row = words(low, offs)
    return span_hashes(low, starts, ends), row


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of k words; of the whole sequence where a row has fewer (but some)."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    count = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    place = np.arange(n) - first[row]
    keep = (place + k <= count[row]) | (place == 0)
    at = np.flatnonzero(keep)
    total = np.zeros(len(at), dtype=np.uint64)
    left = (count[row] - place)[at]
    for j in range(k):
        there = j < left
        factor = np.uint64((_BASES[0] * (2 * j + 1) + 0x632BE59BD9B4E019 * j * j * 2) & _MASK | 1)
        total += np.where(there, mix(hashes[np.minimum(at + j, n - 1)] + np.uint64(j)) * factor, np.uint64(0))
    return mix(total + np.minimum(left, k).astype(np.uint64)), row[at]


def distinct_sorted(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending, rows in order (``row`` must ascend)."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[fresh], row[fresh]


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long that Spark holds."""
    return np.ascontiguousarray(x).view(np.int64)
